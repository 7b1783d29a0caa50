"""Conversations formatted for training, with token masks aligned by offsets.

A conversation is rendered as a whole: each turn is ``start role head_end text end``. Control strings inside roles and texts
are escaped, so that every control string of the output marks a turn. The rendered text is encoded once; control strings are
special ids of the encoder, so that no token crosses from one turn into the next. A token is under the loss mask if its span
meets the span of a text to be learned; both kinds of spans are sorted, so each token finds its turn by binary search.

The rows of a conversation are sorted by Spark and read one after another; a conversation longer than ``SEGMENT_CHARS`` goes
into several output rows, so that neither its number of turns nor a long text decides how much a worker holds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm import library_tokens

#: Characters of one output row, and of the rows encoded together.
SEGMENT_CHARS = 1 << 20
SCHEMA = (
    "conv_id bigint, segment int, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
)
READ_SCHEMA = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
#: A space that may begin a new row: it follows a character that is not white space.
SAFE_SPACE = re.compile(r"(?<=\S) ")


@dataclass(frozen=True)
class Template:
    """Control strings of a turn, and further ones that texts must not hold.

    They are escaped by ``\\`` after their first character. That can be undone in one way only if no control string holds
    the escape, white space or, past its first character, the first character of any of them; this is checked.
    """

    start: str = "[INST]"
    head_end: str = "[/INST]"
    end: str = "</s>"
    others: tuple[str, ...] = ("<s>", "<|endoftext|>")

    def __post_init__(self) -> None:
        firsts = {c[:1] for c in self.controls}
        for c in self.controls:
            if len(c) < 2 or re.search(r"[\\\s]", c) or firsts & set(c[1:]):
                raise ValueError(f"control string {c!r} cannot be escaped")
        if len(set(self.controls)) != len(self.controls):
            raise ValueError("control strings must differ")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.head_end, self.end, *self.others)

    def _pattern(self, escapes: str) -> re.Pattern:
        firsts = sorted({c[0] for c in self.controls})
        rests = [f"{re.escape(f)}(?=\\\\*(?:{'|'.join(re.escape(c[1:]) for c in self.controls if c[0] == f)}))" for f in firsts]
        return re.compile(f"({'|'.join(rests)}){escapes}")

    def escaper(self):
        """Function that escapes a text."""
        found = self._pattern("")
        return lambda text: found.sub(r"\1\\", text)

    def unescaper(self):
        """Function that takes the escapes out again."""
        found = self._pattern(r"\\")
        return lambda text: found.sub(r"\1", text)


def covered(starts: np.ndarray, ends: np.ndarray, token_starts: np.ndarray, token_ends: np.ndarray) -> np.ndarray:
    """Which tokens meet one of the spans; spans are sorted, disjoint and not empty."""
    if not len(starts):
        return np.zeros(len(token_starts), dtype=bool)
    at = np.searchsorted(ends, token_starts, side="right")
    inside = np.minimum(at, len(starts) - 1)
    return (at < len(starts)) & (starts[inside] < token_ends)


class _Formatter:
    """Renders turns in order and encodes what is ready."""

    def __init__(self, content: bytes, template: Template, learn: tuple[str, ...], segment_chars: int):
        from tokenizers import AddedToken, Tokenizer

        self.library = Tokenizer.from_buffer(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in template.controls])
        self.cuts = library_tokens.encoder(content, "json").cuts
        self.template, self.learn, self.limit = template, set(learn), segment_chars
        self.escape = template.escaper()
        self.conv: int | None = None
        self.segment = -1
        self.ready: list[tuple] = []
        self.waiting = 0
        self._clear()

    def _clear(self) -> None:
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []

    def _add(self, text: str, learned: bool = False) -> None:
        if learned and text:
            self.spans.append((self.size, self.size + len(text)))
        self.parts.append(text)
        self.size += len(text)

    def cut(self) -> None:
        """What was rendered so far becomes a row of its own."""
        if not self.parts:
            return
        self.segment += 1
        self.ready.append((self.conv, self.segment, "".join(self.parts), self.spans))
        self.waiting += self.size
        self._clear()

    def turn(self, conv: int | None, role: str, text: str) -> None:
        if conv != self.conv or self.segment < 0 and not self.parts:
            self.cut()
            self.conv, self.segment = conv, -1
        learned = role in self.learn
        self._add(f"{self.template.start}{self.escape(role)}{self.template.head_end}")
        text = self.escape(text)
        at = 0
        while self.cuts and len(text) - at > self.limit:
            space = SAFE_SPACE.search(text, at + self.limit)
            if space is None:
                break
            self._add(text[at : space.start()], learned)
            self.cut()
            at = space.start()
        self._add(text[at:] if at else text, learned)
        self._add(self.template.end)
        if self.size >= self.limit:
            self.cut()

    def encoded(self) -> pa.RecordBatch:
        """The ready rows with ids, spans and masks."""
        ready, self.ready, self.waiting = self.ready, [], 0
        ids, offsets, loss = [], [], []
        for (_, _, _, spans), found in zip(
            ready, self.library.encode_batch([r[2] for r in ready], add_special_tokens=False), strict=True
        ):
            places = np.array(found.offsets, dtype=np.int32).reshape(-1, 2)
            turns = np.array(spans, dtype=np.int64).reshape(-1, 2)
            ids.append(np.array(found.ids, dtype=np.int32))
            offsets.append(places)
            loss.append(covered(turns[:, 0], turns[:, 1], places[:, 0], places[:, 1]))
        edges = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
        flat = np.concatenate(offsets)
        lists = [np.concatenate(ids), np.ascontiguousarray(flat[:, 0]), np.ascontiguousarray(flat[:, 1]), np.concatenate(loss)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in ready], pa.int64()),
                pa.array([r[1] for r in ready], pa.int32()),
                pa.array([r[2] for r in ready], pa.string()),
                *[pa.ListArray.from_arrays(edges, pa.array(values)) for values in lists],
            ],
            ["conv_id", "segment", "formatted", "ids", "starts", "ends", "loss"],
        )


def format_chats(
    turns: DataFrame,
    tokenizer: str,
    template: Template = Template(),
    learn: tuple[str, ...] = ("assistant",),
    segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """Formatted conversations of ``turns (conv_id, turn, role, text)``: a row per conversation, see ``SCHEMA``.

    ``tokenizer`` is a ``.json`` file. ``starts`` and ``ends`` are the tokens' spans in code points of ``formatted``; ``loss``
    tells which tokens lie in texts of the roles ``learn``. Longer conversations have several rows numbered by ``segment``, cut
    between turns or, inside a long text, where the encoder begins a new piece anyway; a long text without such a place stays in
    one row. A conversation's rows follow one another in one partition.

    A null text or role counts as empty. Rows go by ``turn`` (nulls first), ties by role and text; repeated rows are turns of
    their own. Rows without ``conv_id`` make up one conversation with a null id. An empty table gives an empty result. Other
    columns are not read, so their names cannot clash.
    """
    content, kind = library_tokens.vocabulary(tokenizer)
    if kind != "json":
        raise ValueError("masks need a .json tokenizer, whose encoder gives offsets")
    shared = turns.sparkSession.sparkContext.broadcast(content)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = _Formatter(shared.value, template, learn, segment_chars)
        for part in parts:
            for at in range(part.num_rows):
                conv, role, text = (part.column(c)[at].as_py() for c in ("conv_id", "role", "text"))
                formatter.turn(conv, role or "", text or "")
                if formatter.waiting >= segment_chars:
                    yield formatter.encoded()
        formatter.cut()
        if formatter.ready:
            yield formatter.encoded()

    narrow = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    arranged = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return arranged.select("conv_id", "role", "text").mapInArrow(run, SCHEMA)


class _Reader:
    """Reads a conversation's rows in order; turns by the control strings, learned text by the masks."""

    def __init__(self, conv: int | None, template: Template):
        self.conv, self.template, self.unescape = conv, template, template.unescaper()
        self.marks = re.compile("|".join(re.escape(c) for c in (template.start, template.head_end, template.end)))
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> None:
        self.chars += len(formatted)
        at = 0
        for mark in self.marks.finditer(formatted):
            self._text(formatted[at : mark.start()])
            at = mark.end()
            if mark.group() == self.template.start:
                self.n_turns += 1
            else:
                self.turns.update(b"\n")
        self._text(formatted[at:])
        starts, ends = starts[loss], ends[loss]
        if len(starts):
            apart = np.flatnonzero(starts[1:] > ends[:-1])
            for a, b in zip(starts[np.append(0, apart + 1)].tolist(), ends[np.append(apart, len(ends) - 1)].tolist(), strict=True):
                text = self.unescape(formatted[a:b])
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def _text(self, escaped: str) -> None:
        self.turns.update(self.unescape(escaped).encode())

    def row(self) -> tuple:
        return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_chats(formatted: DataFrame, template: Template = Template(), arranged: bool = False) -> DataFrame:
    """What a training job would see in the rows of :func:`format_chats`, per conversation; see ``READ_SCHEMA``.

    ``turns_sha256`` digests ``role, \\n, text, \\n`` of every turn, ``loss_sha256`` the text under the mask, both unescaped.
    ``arranged`` says that a conversation's rows follow one another, as they come from :func:`format_chats`; rows read from
    files are sorted first.
    """

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader: _Reader | None = None
        for part in parts:
            done = []
            for at in range(part.num_rows):
                conv = part.column("conv_id")[at].as_py()
                if reader is None or reader.conv != conv:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(conv, template)
                lists = [part.column(c)[at].values.to_numpy(zero_copy_only=False) for c in ("starts", "ends", "loss")]
                reader.read(part.column("formatted")[at].as_py(), *lists)
            if done:
                yield _table(done)
        if reader is not None:
            yield _table([reader.row()])

    rows = formatted.select("conv_id", "segment", "formatted", "starts", "ends", "loss")
    if not arranged:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return rows.mapInArrow(run, READ_SCHEMA)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
