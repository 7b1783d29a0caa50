"""Batch encoding with the tokenizer libraries, each distinct stretch of text encoded once.

A text may be cut before a space that follows a character which is not white space: the byte-level pre-tokenizer always
begins a new piece there, whatever stands on either side, so the ids of the whole text are the ids of the stretches in
order. Stretches repeat a lot, so a bounded table keeps what was encoded. Where a vocabulary file asks for anything that
could look across such a place (normalizers, prefix spaces, special strings with spaces), texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np

from gradeloom.llm import batches, slices

#: Entries of a worker's table, and the longest stretch that is kept in it.
TABLE_ENTRIES = 600_000
TABLE_BYTES = 64


def cut_places(raw: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where stretches start in UTF-8 bytes: at every text's start and at every safe space.

    White space of more than one byte is told by its last two bytes, which may also end another character; then a place
    that would be safe is left out.
    """
    one = raw[:-1]
    space = (one == 0x20) | ((one >= 0x09) & (one <= 0x0D)) | ((one >= 0x1C) & (one <= 0x1F))
    wide = one >= 0x80
    wide[1:] &= np.isin(raw[:-2], (0xC2, 0x9A, 0x80, 0x81)) if len(raw) > 2 else True
    wide &= (one <= 0x8A) | np.isin(one, (0x9F, 0xA0, 0xA8, 0xA9, 0xAF))
    starts = np.zeros(len(raw), dtype=bool)
    starts[1:] = (raw[1:] == 0x20) & ~space & ~wide
    starts[text_starts] = True
    return np.flatnonzero(starts)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, or their number."""

    def __init__(self, content: bytes, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.table: dict[bytes, bytes] = {}
        if kind == "json":
            from tokenizers import Tokenizer

            library = Tokenizer.from_buffer(content)
            library.no_truncation()
            library.no_padding()
            self.cuts = _cuts_are_safe(json.loads(content))
            self.encode = lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
            if self.cuts:
                size = library.get_vocab_size(with_added_tokens=True)
                self.spaced = np.array([(library.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        elif kind == "model":
            from sentencepiece import SentencePieceProcessor

            library = SentencePieceProcessor(model_proto=content)
            self.cuts = False
            self.encode = lambda texts: library.encode(texts, num_threads=1)
        else:
            raise ValueError(f"a tokenizer file ends in .json or .model, not {kind!r}")

    def counts(self, texts: list[str]) -> list[int]:
        if not self.cuts:
            return [len(ids) for ids in self.encode(texts)]
        done = []
        for part in _parts(texts):
            found, which, first, last = self._stretches(part)
            sizes = np.array([len(f) // 4 for f in found], dtype=np.int64)
            done.append(slices.totals(sizes[which], first, last))
        return np.sum(done, axis=0).tolist()

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return [np.asarray(ids, dtype="<u4").tobytes() for ids in self.encode(texts)]
        done = [self._ids_at_once(part) for part in _parts(texts)]
        return done[0] if len(done) == 1 else [b"".join(ids for (ids,) in done)]

    def _ids_at_once(self, texts: list[str]) -> list[bytes]:
        found, which, first, last = self._stretches(texts)
        sizes = np.array([len(f) // 4 for f in found], dtype=np.int64)
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        out = slices.gather(flat, np.cumsum(sizes) - sizes, sizes, which).tobytes()
        ends = np.cumsum(slices.totals(sizes[which], first, last)) * 4
        edges = [0, *ends.tolist()]
        return [out[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def _stretches(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct stretches, the number of each stretch, and each text's first and last stretch."""
        encoded = [t.encode() for t in texts]
        raw = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        sizes = np.array([len(e) for e in encoded], dtype=np.int64)
        ends = np.cumsum(sizes)
        if not len(raw):
            none = np.zeros(len(texts), dtype=np.int64)
            return [], none[:0], none, none
        starts = cut_places(raw, (ends - sizes)[sizes > 0])
        parts, which = slices.distinct(raw, starts, np.append(starts[1:], len(raw)))
        known = self.table
        new = [p for p in parts if p not in known]
        self._learn(new)
        found = [known[p] for p in parts]
        if len(known) > TABLE_ENTRIES:
            known.clear()
        else:
            for p in new:
                if len(p) > TABLE_BYTES:
                    del known[p]
        return found, which, np.searchsorted(starts, ends - sizes), np.searchsorted(starts, ends)

    def _learn(self, new: list[bytes]) -> None:
        """Encode new stretches. Those with one space, at the front, and no white space at the end are encoded as one
        text: its ids fall apart again where a token starts with a space."""
        decoded = [p.decode() for p in new]
        joint = [i for i, s in enumerate(decoded) if s[0] == " " and s.count(" ") == 1 and not s[-1].isspace()]
        alone = sorted(set(range(len(new))) - set(joint))
        for i, ids in zip(alone, self.encode([decoded[i] for i in alone]), strict=True):
            self.table[new[i]] = np.asarray(ids, dtype="<u4").tobytes()
        if joint:
            ids = np.asarray(self.encode(["".join(decoded[i] for i in joint)])[0], dtype="<u4")
            edges = [*np.flatnonzero(self.spaced[ids]).tolist(), len(ids)]
            if len(edges) != len(joint) + 1:
                raise ValueError("this vocabulary has tokens with inner spaces; encode whole texts")
            data = ids.tobytes()
            for i, a, b in zip(joint, edges, edges[1:], strict=False):
                self.table[new[i]] = data[4 * a : 4 * b]


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """The texts as they are, or one long text in stretches."""
    if len(texts) == 1 and len(texts[0]) > batches.LONG_BYTES:
        for part in batches.stretches(texts[0].encode(), batches.SAFE_SPACE):
            yield [part.decode()]
    else:
        yield texts


def _cuts_are_safe(spec: dict) -> bool:
    pre = spec.get("pre_tokenizer") or {}
    whole = (
        spec.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and spec.get("model", {}).get("type") == "BPE"
        and not spec["model"].get("dropout")
    )
    plain = all(
        not re.search(r"\s", a["content"]) and not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"])
        for a in spec.get("added_tokens", [])
    )
    return bool(whole and plain)


_LOADED: dict[tuple[str, str], Encoder] = {}


def encoder(content: bytes, kind: str) -> Encoder:
    """The encoder of a vocabulary file's content; made once per worker process."""
    key = (hashlib.sha256(content).hexdigest(), kind)
    if key not in _LOADED:
        _LOADED[key] = Encoder(content, kind)
    return _LOADED[key]


def vocabulary(path: str) -> tuple[bytes, str]:
    """Content and kind of a vocabulary file, read where the job is planned: workers need not see the path."""
    return Path(path).read_bytes(), Path(path).suffix.lstrip(".")
