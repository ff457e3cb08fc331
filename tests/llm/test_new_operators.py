"""Byte-level BPE, whitening and fill-in-the-middle against a library, brute force and round trips."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import types as T

from branchlens.llm import bpe, contour, fill_middle, whitening

EXTRA = "doc_id long, text string, ids string, n long, form string, x string, packed string, bytes string, output string"
TEXTS = [
    (0, "It's a plain text, isn't it?  Two  spaces\tand a tab\n\n\nlines \n"),
    (1, "naïve Übergröße 漢字かな交じり文 \U0001f600\U0001f3fd é    x"),
    (1, "naïve Übergröße 漢字かな交じり文 \U0001f600\U0001f3fd é    x"),
    (2, None),
    (3, ""),
    (None, "no id <|endoftext|> here"),
    (4, "\n\n"),
    (5, "a" * 30_000),
    (6, "".join(random.Random(1).choices("abcdefghijklmnop", k=20_000))),
    (7, "word " * 20_000),
    (8, " \n \r\n  12345678901234567890 ==== ----"),
]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "a", 1, "b", "c", "d", "e", "f") for i, t in texts], EXTRA)


@pytest.fixture(scope="module")
def library():
    with open(bpe.RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def as_bag(rows):
    return sorted(rows, key=str)


def test_byte_bpe_equals_the_library_and_restores_the_text(spark, library):
    encoded = bpe.encode(docs(spark))
    want = [(i, library.encode_ordinary(t or "")) for i, t in TEXTS]
    assert as_bag((r.doc_id, r.ids) for r in encoded.collect()) == as_bag(want)
    back = [(r.doc_id, bytes(r.bytes).decode()) for r in bpe.decode(encoded).collect()]
    assert as_bag(back) == as_bag((i, t or "") for i, t in TEXTS)


def test_byte_bpe_query_equals_the_library(spark, small, library):
    want = []
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = bpe.op11_byte_bpe(spark, small)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert as_bag(tuple(r) for r in got.collect()) == as_bag(want)


def test_byte_bpe_of_no_rows_and_null_ids(spark):
    assert bpe.encode(docs(spark).where("false")).count() == 0
    assert bpe.round_trip(docs(spark).where("false")).count() == 0
    ids = spark.createDataFrame([(1, None), (None, [])], "doc_id long, ids array<int>")
    assert as_bag((r.doc_id, bytes(r.bytes)) for r in bpe.decode(ids).collect()) == as_bag([(1, b""), (None, b"")])


def smallest_first(ids, word):
    """One merge after the other, each found by looking at all pairs."""
    parts = [bytes([b]) for b in word]
    if word in ids:
        return [ids[word]]
    while True:
        ranks = [(ids[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ids]
        if not ranks:
            return [ids[p] for p in parts]
        i = min(ranks)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_replay_with_ranks_that_fall_as_tokens_grow():
    """A merge may open a pair with a smaller rank; it then comes before others of the word."""
    rng = random.Random(5)
    for _ in range(60):
        longer = {"".join(rng.choices("abc", k=rng.randint(2, 4))).encode() for _ in range(14)}
        tokens = [bytes([b]) for b in range(256)] + rng.sample(sorted(longer), len(longer))
        ranks = bpe.Ranks(tuple(tokens), "own")
        ids = {t: i for i, t in enumerate(tokens)}
        words = ["".join(rng.choices("abc", k=rng.randint(1, 12))).encode() for _ in range(40)]
        got = [np.frombuffer(b, "<u4").tolist() for b in bpe.Replay(ranks)(words)]
        assert got == [smallest_first(ids, w) for w in words]


def test_replay_in_pieces_and_a_forgetful_encoder(monkeypatch, library):
    text = " ".join(t or "" for _, t in TEXTS[:2]) * 20
    monkeypatch.setattr(bpe, "REPLAYED", 7)
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder = bpe.Encoder(bpe.load_ranks(), bpe.PATTERN)
    for _ in range(2):
        (packed,) = encoder([text])
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)


# --- whitening ---------------------------------------------------------------


def test_inertia_counts():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 30):
        for _ in range(10):
            a = rng.standard_normal((d, d))
            a = a + a.T
            values = np.linalg.eigvalsh(a)
            for s in (-3.0, -0.1, 0.0, 0.4, 2.0):
                assert contour.inertia_above(a, s) == (values > s).sum()
    hollow = np.array([[0.0, 1, 2], [1, 0, 3], [2, 3, 0]])
    assert contour.inertia_above(hollow, 0.0) == (np.linalg.eigvalsh(hollow) > 0).sum()


@pytest.mark.parametrize("case", ["wide", "close", "ties", "low rank", "one"])
def test_eigenpairs_equal_a_full_decomposition(case):
    rng = np.random.default_rng(4)
    d = 1 if case == "one" else 50
    values = {
        "wide": 10.0 ** -np.arange(d),
        "close": 1 + 1e-6 * np.arange(d),
        "ties": np.repeat(np.arange(1.0, 11.0), 5),
        "low rank": np.where(np.arange(d) < 3, 5.0 + np.arange(d), 0),
        "one": np.array([2.0]),
    }[case]
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, vectors = contour.largest_eigenpairs(a, 8)
    want = np.sort(values)[::-1][: min(8, 3 if case == "low rank" else d)]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-9 if case != "wide" else 1e-3, atol=1e-13)
    assert np.abs(a @ vectors - vectors * got).max() < 1e-12 * abs(a).sum(axis=1).max()
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12


def test_eigenpairs_of_nothing():
    assert contour.largest_eigenpairs(np.zeros((4, 4)), 8)[1].shape == (4, 0)
    assert contour.largest_eigenpairs(np.zeros((0, 0)), 8)[1].shape == (0, 0)


def vectors(spark, rows, kind="float"):
    fields = f"vec_id long, embedding array<{kind}>, label int, n string, x string, component string, i int, j int, s int"
    return spark.createDataFrame([(i, v, 1, "a", "b", "c", 1, 2, 3) for i, v in rows], fields)


def brute_force(rows, k=8):
    """Whitening of all rows at once, by a full decomposition."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in kept], object)
    n, sums = len(x), x.sum(axis=0)
    scaled = x * n - sums
    y = scaled.astype(float) / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    trace = np.trace(y.T @ y / n)
    return {
        (i, c + 1): (n, int((scaled[r] * scaled[r]).sum()), (y[r] @ axes[:, c]) / np.sqrt(values[c]), values[c] / trace)
        for r, (i, _) in enumerate(kept)
        for c in range(len(values))
    }


def compare(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want)
    for c in {r.component for r in got}:
        mine = [(r, want[r.vec_id, c]) for r in got if r.component == c]
        side = np.sign(sum(r.whitened * w[2] for r, w in mine))
        for r, w in mine:
            assert (r.n, r.deviation) == w[:2]
            assert r.whitened * side == pytest.approx(w[2], rel=1e-7, abs=1e-7)
            assert r.explained == pytest.approx(w[3], rel=1e-9)
            assert 0 <= r.identity_error < 1e-9


@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitening_equals_brute_force(spark, kind):
    rng = np.random.default_rng(6)
    spread = np.linspace(1, 3, 12)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(12) * spread + 2]) for i in range(300)]
    bad = [(1000, None), (1001, []), (1002, [1.0] * 11 + [None]), (1003, [float("nan")] * 12), (1004, [float("inf")] * 12), (None, None)]
    got = whitening.whiten(vectors(spark, rows + bad, kind)).collect()
    assert len(got) == 300 * 8
    compare(got, brute_force(rows))


def test_whitening_query_equals_brute_force(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = whitening.op12_whitening(spark, small)
    assert got.columns == [f.split()[0] for f in whitening.FIELDS.split(", ")]
    compare(got.collect(), brute_force(rows))


def test_whitening_of_few_equal_and_uneven_vectors(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None)])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    # Two different vectors span one component; one of another length is dropped; ids repeat.
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -2.0]), (4, [1.0, 2.0, 3.0])]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert as_bag((r.vec_id, r.component, r.n) for r in got) == as_bag([(1, 1, 3), (1, 1, 3), (None, 1, 3)])
    assert all(r.explained == pytest.approx(1) and r.identity_error < 1e-12 for r in got)


def test_whitening_with_sums_beyond_64_bits(spark):
    rows = [(i, [float((i * 7919) % 1000 * 2**31), float(i)]) for i in range(50)]
    got = whitening.whiten(vectors(spark, rows, "double")).collect()
    want = brute_force(rows)
    assert {r.deviation for r in got} == {None}
    x = [want[i, 1][1] for i in range(50)]
    assert min(x) >= 1 << 63
    assert len(got) == 50  # beside the first, the second component is zero within rounding


def test_numeric_type_of_vectors(spark):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.LongType()))])
    rows = [(i, [i, i * i % 7, 3]) for i in range(20)]
    compare(whitening.whiten(spark.createDataFrame(rows, schema)).collect(), brute_force(rows, 2))


# --- fill in the middle ------------------------------------------------------


def line_by_line(doc_id, text, rate=100, spm=50):
    text = text or ""
    *whole, last = text.split("\n")
    units = [u + "\n" for u in whole] + ([last] if last else [])
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


LINES = TEXTS + [
    (20, "one line"),
    (21, "a <M> mark\nin it\n"),
    (22, "<\n<P\n<S\n>\n"),
    (23, "\r\n \x0b\x85 others are no line ends"),
    *((i, "first\n\nthird \U0001f600\nlast" + "\n" * (i % 2)) for i in range(30, 60)),
    (60, "x\n" * 50_000),
]


@pytest.mark.parametrize("rate,spm", [(100, 50), (40, 0), (100, 100), (0, 50)])
def test_fill_in_middle_equals_brute_force(spark, rate, spm):
    got = fill_middle.fill_in_middle(docs(spark, LINES), rate=rate, spm_rate=spm).collect()
    want = [(i, *line_by_line(i, t, rate, spm), t or "") for i, t in LINES]
    assert as_bag(tuple(r) for r in got) == as_bag(want)
    if (rate, spm) == (100, 50):
        assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_no_rows(spark):
    assert fill_middle.fill_in_middle(docs(spark).where("false")).count() == 0


def test_restoring_needs_output_and_form_alone():
    transform = fill_middle.Transform(7, 100, 50, fill_middle.LINE, fill_middle.MARKS)
    parts = ["<", "<S", "P>", "\n", "x<", ">"]
    for doc_id, chosen in enumerate(itertools.product(parts, repeat=4)):
        text = "".join(chosen)
        _, form, _, _, output = transform(doc_id, text)
        assert transform.restore(output, form) == text


def test_other_units_and_marks():
    words = fill_middle.Transform(7, 100, 50, r"\s*\S+\s*", ("<pre>", "[suf]", "{mid}"))
    n, form, *_, output = words(3, " two words ")
    assert n == 2 and words.restore(output, form) == " two words "
    with pytest.raises(ValueError, match="cover"):
        fill_middle.Transform(7, 100, 50, "a", fill_middle.MARKS)(1, "ab")
    with pytest.raises(ValueError, match="overlap"):
        fill_middle.Transform(7, 100, 50, "a", ("<P>", "P><", "<M>"))
