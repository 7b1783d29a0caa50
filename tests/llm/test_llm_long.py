"""Long texts: the same results in stretches, in a few times the size of the text."""

import hashlib
import subprocess
import sys
import textwrap
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradeloom.llm import batches, byte_bpe, library_tokens, quality_mil, shingles

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
PARTS = ["word ", " ", "  ", "\t", "é", "日本 ", "  ", "　 ", "  ", "\n", "it's ", "12 ", "<|endoftext|>", "!? ", "\x1c ", "x" * 40]


def texts():
    return st.lists(st.sampled_from(PARTS), max_size=60).map("".join)


@settings(max_examples=150, deadline=None)
@given(text=texts(), size=st.integers(1, 60))
def test_stretches_put_together(text, size):
    data = text.encode()
    for cut in (batches.WHITE, batches.SAFE_SPACE):
        parts = list(batches.stretches(data, cut, size))
        assert b"".join(parts) == data and all(p.decode() is not None for p in parts)


@settings(max_examples=60, deadline=None)
@given(text=texts(), size=st.sampled_from([5, 23, 61]))
def test_results_do_not_depend_on_stretches(text, size):
    data = text.encode()
    ranks = byte_bpe.ranks_of(Path(RANKS).read_bytes())
    encoder = library_tokens.encoder(*library_tokens.vocabulary(JSON))
    (whole,) = ranks.encode([text])
    want = (len(whole.ids), hashlib.sha256(ranks.decimals(whole.ids)).hexdigest(), hashlib.sha256(data).hexdigest(), len(whole.offsets))
    counts, ids = encoder.counts([text]), encoder.ids([text])
    sets = [shingles.shingle_sets([data], w) for w in (1, 4)]
    model = [quality_mil.start_model(s) for s in (1, 2)]
    score = quality_mil.scores(model, [data])
    keep, batches.LONG_BYTES = batches.LONG_BYTES, size
    defaults, batches.stretches.__defaults__ = batches.stretches.__defaults__, (size,)
    try:
        assert ranks.digests(data) == want
        assert encoder.counts([text]) == counts and encoder.ids([text]) == ids
        for w, (hashes, n) in zip((1, 4), sets, strict=True):
            got, m = shingles.shingle_sets([data], w)
            assert got.tolist() == hashes.tolist() and m.tolist() == n.tolist()
        assert b"".join(quality_mil.slabs(data)) == data
        assert abs(quality_mil.scores(model, [data]) - score).max() < 1e-5
    finally:
        batches.LONG_BYTES, batches.stretches.__defaults__ = keep, defaults


PROBE = """
    import resource, sys
    import numpy as np
    from pathlib import Path
    from gradeloom.llm import byte_bpe, library_tokens, minhash, quality_mil
    n = 64 << 20
    words = [b"w%d" % (i * 7919 % 400_003) for i in range(400_003)]
    line = b" ".join(words) + b". "
    text = (line * (n // len(line) + 1))[:n]
    peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
    what = sys.argv[1]
    if what == "bpe":
        ranks = byte_bpe.ranks_of(Path(sys.argv[2]).read_bytes())
        ranks.encode(["warm up"])
    if what in ("counts", "ids"):
        encoder = library_tokens.encoder(*library_tokens.vocabulary(sys.argv[2]))
        encoder.counts(["warm up"])
    if what == "score":
        models = [quality_mil.start_model(1)]
    base = peak()
    if what == "bpe":
        ranks.digests(text)
    elif what == "counts":
        encoder.counts([text.decode()])
    elif what == "ids":
        encoder.ids([text.decode()])
    elif what == "sets":
        minhash.signatures([text], 5)
    else:
        quality_mil.scores(models, [text])
    print(peak() - base)
"""


@pytest.mark.parametrize(("what", "path"), [("bpe", RANKS), ("counts", JSON), ("ids", JSON), ("sets", ""), ("score", "")])
def test_a_text_of_64_mb_takes_under_600_mb(what, path):
    found = subprocess.run([sys.executable, "-c", textwrap.dedent(PROBE), what, path], capture_output=True, text=True, timeout=280, cwd=Path(__file__).parents[2])
    assert found.returncode == 0, found.stderr[-500:]
    assert float(found.stdout) < 600, found.stdout
