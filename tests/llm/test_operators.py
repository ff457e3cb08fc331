"""Small tables with nulls, empty texts, repeated rows and clashing column names; brute force beside."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from branchlens.llm import (
    decontam,
    fingerprints,
    jaccard,
    language,
    licenses,
    line_dedup,
    pieces,
    quality,
    sentencepieces,
    token_counts,
    warc,
)
from branchlens.llm.common import DOCUMENT_COLUMNS, components

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, key string, sig long, row long, doc long, th long, n long, ll string"
LONG = "word " * 30_000


def table(spark, texts, lang="en"):
    rows = [(i, t, lang, "s", None if t is None else len(t), "k", 1, 1, 1, 1, 1, "x") for i, t in texts]
    return spark.createDataFrame(rows, EXTRA)


def shingles(text, n=4):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def awkward(spark):
    a = "one two three four five six seven eight nine ten eleven twelve\nshared line of text here\n"
    return table(
        spark,
        [(0, a), (1, a + "!"), (1, a + "!"), (2, None), (3, ""), (None, "no id at all, really"), (4, "\n\n"), (5, "x"), (6, LONG), (7, "ü 漢字 \U0001f600  two  spaces\t")],
    )


OPERATORS = {
    "tokens": token_counts.token_counts,
    "language": language.identify_documents,
    "pieces": sentencepieces.encode,
    "fingerprints": fingerprints.fingerprints,
    "lines": line_dedup.dedup_lines,
    "jaccard": jaccard.linked_groups,
    "licences": licenses.scan,
    "quality": lambda d: quality.score(d, quality.Machine.empty()),
    "contamination": lambda d: decontam.contamination(d, d.selectExpr("doc_id as item_id", "text").where("doc_id < 3")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_give_one_row_each(spark, name):
    out = OPERATORS[name](awkward(spark)).select("doc_id").collect()
    assert sorted(-1 if r[0] is None else r[0] for r in out) == [-1, 0, 1, 1, 2, 3, 4, 5, 6, 7]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](awkward(spark).where("false")).count() == 0


def test_counts_equal_encoded_lengths_and_decoding_restores(spark):
    docs = awkward(spark)
    counts = sorted((str(r.doc_id), r.n_tokens) for r in token_counts.token_counts(docs).collect())
    encoded = sentencepieces.encode(docs)
    assert counts == sorted((str(r.doc_id), len(r.ids)) for r in encoded.collect())
    texts = sorted(r.text or "" for r in docs.collect())
    assert sorted(r.text for r in sentencepieces.decode(encoded).collect()) == texts
    assert all(r.lossless for r in encoded.collect())


def best_segmentation(p, word):
    """Score and length of the best segmentation, over all of them."""
    best = None
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, last = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[last:i])
                last = i
        parts.append(word[last:])
        if all(x in p.scores for x in parts):
            total = sum(p.scores[x] for x in parts)
            best = max(best, total) if best is not None else total
    return best


def test_viterbi_and_trie_find_the_best_score(spark):
    p = pieces.load_pieces()
    encoder, trie = sentencepieces.Encoder(p), token_counts.CountTrie(p)
    for word in ("▁thershed", "▁ouondent", "▁a", "keit.", "▁▁lang"):
        ids = np.frombuffer(encoder.word(word), np.int32)
        assert sum(p.scores[p.texts[i]] for i in ids) == best_segmentation(p, word)
        assert trie.count(word) == len(ids)


def test_encoding_never_scores_below_the_library_in_unigram_mode():
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = proto.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    other = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    p = pieces.load_pieces()
    encoder = sentencepieces.Encoder(p)
    score = lambda ids: sum(p.scores[p.texts[i]] for i in ids)
    for text in ("Is and retitioning ouen the of, nterti", "De éon éouonque surleaitre", "", "x"):
        assert score(encoder(text).tolist()) >= score(other.encode(text))


def test_jaccard_against_all_pairs(spark):
    random = np.random.default_rng(3)
    texts, base = [], None
    for i in range(60):
        if i % 6 == 0:
            base = [f"w{x}" for x in random.integers(0, 50, random.integers(3, 90))]
        mine = list(base)
        for _ in range(i % 6 // 2):
            mine[random.integers(0, len(mine))] = f"z{i}"
        texts.append((i, " ".join(mine)))
    sets = {}
    for i, t in texts:
        w = t.lower().split()
        sets[i] = {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))}
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                root[a] = root[b] = min(root[a], root[b])
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_groups(table(spark, texts)).collect()}
    assert out == {i: (len(s), root[i]) for i, s in sets.items()}
    assert len(set(root.values())) < len(sets)


@pytest.mark.parametrize("percent", [85, 80])
def test_linked_sets_share_a_signature(percent):
    random, bands = np.random.default_rng(5), jaccard.Bands(percent)
    for size in (1, 5, 6, 7, 9, 12, 13, 20, 40, 200, 900):
        for _ in range(40):
            a = np.unique(random.integers(0, 1 << 63, size).astype(np.uint64))
            both = -(-percent * len(a) // 100)
            more = random.integers(0, 1 << 63, len(a) * 100 // percent - len(a)).astype(np.uint64)
            for b in (a[:both], np.unique(np.concatenate((a, more)))):
                common = len(np.intersect1d(a, b))
                if len(a) != len(b) and 100 * common >= percent * (len(a) + len(b) - common):
                    assert np.intersect1d(bands.signatures(a), bands.signatures(b)).size


def test_linked_sets_share_a_signature_at_the_last_turn(monkeypatch):
    """With one turn only, empty pairs are emitted; with more, sets that end at different turns meet."""
    random = np.random.default_rng(6)
    for turns in (1, 2, 3):
        monkeypatch.setattr(jaccard, "TURNS", turns)
        monkeypatch.setattr(jaccard, "_spare", lambda need, smallest: 0)
        bands = jaccard.Bands(60)  # thin groups: most sets have empty pairs
        for size in (5, 9, 17, 40):
            for _ in range(150):
                a = random.integers(0, 1 << 63, size).astype(np.uint64)
                b = a[: -(-60 * size // 100)]
                assert np.intersect1d(bands.signatures(a), bands.signatures(b)).size


@pytest.mark.parametrize("percent", [85, 80])
def test_unrelated_sets_share_no_signature(percent):
    random, bands = np.random.default_rng(7), jaccard.Bands(percent)
    for size in (*range(1, 41), 120):
        signs = [np.unique(bands.signatures(random.integers(0, 1 << 63, size).astype(np.uint64))) for _ in range(2000)]
        _, counts = np.unique(np.concatenate(signs), return_counts=True)
        assert counts.max(initial=0) <= 20


def test_overlong_runs_are_spread_as_pairs_of_blocks(spark, monkeypatch):
    """Documents of one template, just under the limit: many sets share signatures and no links."""
    monkeypatch.setattr(jaccard, "RUN", 6)
    common = " ".join(f"w{i}" for i in range(60))
    texts = [(i, common + " " + " ".join(f"d{i}x{j}" for j in range(12))) for i in range(40)]
    texts += [(100 + i, common + " " + " ".join(f"d{i}x{j}" for j in range(11)) + " z") for i in range(0, 40, 7)]
    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}
    for (i, a), (j, b) in itertools.combinations(sets.items(), 2):
        if 100 * len(a & b) >= 85 * len(a | b):
            top = min(root[i], root[j])
            root.update({x: top for x in root if root[x] in (root[i], root[j])})
    out = {r.doc_id: r.component_id for r in jaccard.linked_groups(table(spark, texts)).collect()}
    assert out == root and len(set(root.values())) == 40
    rows = spark.createDataFrame([(s, k) for s in (1, 2) for k in range(20 if s == 1 else 3)], "sig long, key long")
    spread = jaccard._in_blocks(rows).collect()
    runs = {}
    for r in spread:
        runs.setdefault(r.sig, set()).add(r.key)
    assert runs.pop(2) == {0, 1, 2}
    met = {p for keys in runs.values() for p in itertools.combinations(sorted(keys), 2)}
    assert met == set(itertools.combinations(range(20), 2)) and max(map(len, runs.values())) < 20


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    out = dict(components(spark.createDataFrame(edges, "a long, b long")).distinct().collect())
    assert {out[i] for i in range(100, 141)} == {100} and {out[i] for i in range(200, 260)} == {7}


def test_warc_rejects_records_inside_payloads(spark, tmp_path):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    big = ("<p>text</p>" * 40 + inner) * 60
    pages = [(1, "http://a/", inner), (2, None, big), (3, "http://b\r\n/", big), (4, "u", None), (None, "v", "ü" * 90), (5, "w", "short"), (6, "w", "short"), (3, "x", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # payloads run over several splits
    try:
        warc.write_archives(df, str(tmp_path / "w"))
        got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(r.intact for r in got)
    want = sorted(
        (str(p), len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if h == big and p == 3 else "response", 2 if h == big and p == 3 else None)
        for p, _, h in pages
    )
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want


def test_exact_and_proximity_matches(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma alpha"), (2, None), (None, "beta gamma")], "item_id long, text string")
    docs = table(spark, [(0, "x Alpha, beta gamma ALPHA y"), (1, "gamma alpha beta x alpha"), (2, "beta gamma")])
    rows = {r.doc_id: r for r in decontam.contamination(docs, items).collect()}
    assert [(rows[i].n_words, rows[i].n_hit, rows[i].items) for i in range(3)] == [
        (6, 4, ["1", "null"]), (5, 0, []), (2, 2, ["null"]),
    ]
    index = decontam.build_index(docs, items)
    size = index.windows.where("size = 4").select("wid").distinct().first().wid
    near = decontam.proximity_matches(index).where(F.col("wid") == size).select("row").distinct().count()
    assert near == 2


def test_fingerprint_likeness_is_near_weighted_jaccard():
    sampler = fingerprints.Sampler(512)
    a, b = "a a a b c d e f", "a b b c d x y"
    x, y = ({t: s.split().count(t) for t in s.split()} for s in (a, b))
    words = set(x) | set(y)
    exact = sum(min(x.get(t, 0), y.get(t, 0)) for t in words) / sum(max(x.get(t, 0), y.get(t, 0)) for t in words)
    assert abs(fingerprints.likeness(sampler(a), sampler(b)) - exact) < 0.09
    assert fingerprints.likeness(sampler(a), sampler(a)) == 1


def test_fingerprints_edit_with_the_next_document(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    ids = sorted(texts)
    for r in fingerprints.fingerprints(docs).collect():
        mine, after = texts[r.doc_id], texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        half = len(mine) // 2
        changed = mine[: len(mine) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(mine), hashlib.sha256(changed.encode()).hexdigest())


def test_perfect_hash_is_minimal():
    h = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    at = line_dedup.PerfectHash(*line_dedup.build_hash(h))(h)
    assert sorted(at) == list(range(len(h)))


def test_licences_against_plain_search(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    found = {r.doc_id: r.n_licenses for r in licenses.scan(docs).collect()}
    short = [t for _, t in licenses.TEMPLATES]
    norm = lambda t: " " + " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())) + " "
    wanted = {r.doc_id: sum(norm(t) in norm(r.text) for t in short) for r in docs.collect()}
    assert found == wanted and sum(wanted.values())


def test_quality_on_held_out_rows(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    out = quality.score(docs, quality.train(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.score for r in out if r.quality == q] for q in (1, 0))
    assert good and bad and np.mean([g > b for g in good for b in bad]) > 0.9


def test_machine_equals_the_sum_over_pairs():
    m = quality.Machine.empty()
    at, x = np.array([1, 5, 9]), np.array([0.5, 1.0, 2.0])
    pairs = sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j] for i in range(3) for j in range(i))
    assert abs(m.raw(at, x) - pairs) < 1e-12


def test_language_accuracy_and_fused_evidence(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    train, rest = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    model = language.train(train)
    rows = rest.selectExpr("doc_id", "lang", "text", "source as host", "'' as suffix", "cast(null as string) as declared")
    out = language.fuse(language.likelihoods(rows, model, ["doc_id", "lang", "host", "suffix", "declared"]), model[0], ["doc_id", "lang"])
    assert out.where("lang = language").count() >= 0.99 * rest.count()


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        now = docs.count()
        assert 0 < now <= n
        n = now
    assert corpus_pipeline.run(spark, small).count() == n


def planted(spark, folder):
    """Documents with copies, repeated ids, no ids, shared lines and benchmark passages, and the other tables."""
    random = np.random.default_rng(21)
    vocabulary = [f"{a}{b}{c}" for a in ("ba", "lo", "mi", "ten", "su") for b in ("ra", "ni", "ko") for c in ("x", "lan", "de", "r")]
    prose = lambda n: " ".join(vocabulary[i] for i in random.integers(0, len(vocabulary), n))
    rows = [(i, "\n".join(prose(40) for _ in range(3))) for i in range(60)]
    shared, passage = prose(30), prose(12)
    rows += [(100 + i, f"{prose(60)}\n{shared}\n{prose(60)}") for i in range(6)]
    rows += [(200 + i, f"{prose(30)} {passage.upper()} {prose(30)}") for i in range(4)]
    # Near copies on one line each, so that line dedup leaves them alone.
    near = prose(120)
    rows += [(300 + i, f"{near} {prose(i)}") for i in range(5)]
    rows += [(5, rows[5][1]), (7, prose(50)), (None, rows[9][1] + " more"), (None, prose(70)), (400, rows[3][1]), (None, None), (401, ""), (402, " \n ")]
    documents = spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return [tuple(r) for r in documents.select("doc_id", "text").collect()], passage


def plain_line_dedup(rows):
    none = 1 << 62
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(none if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 2 or min(held[key(x)]) == (none if i is None else i)]
        text = "\n".join(kept)
        if len(kept) == len(lines) or text.strip(" \t\n\v\f\r"):
            out.append((i, text))
    return out


def plain_near_copies(rows):
    """One document of each group of near copies, by all pairs of (id, text)."""
    documents = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    sets, root = [shingles(t, 5) for _, t in documents], list(range(len(documents)))
    for i, j in itertools.combinations(range(len(documents)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
    return [d for i, d in enumerate(documents) if root[i] == i]


def test_pipeline_against_plain_python(spark, tmp_path):
    rows, passage = planted(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    known = {r.doc_id is None and "none" or r.doc_id: r.accepted for r in language.identify_documents(docs, spark.read.parquet(f"{tmp_path}/pages.parquet")).collect()}
    bag = lambda rows: sorted((str(i), t or "") for i, t in rows)

    def stage(name, docs):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
        return out, [tuple(r) for r in out.select("doc_id", "text").collect()]

    # Texts of a few words are of no language; the planted prose is of one.
    assert known[401] is False and known[5] is True
    docs, now = stage("language_id", docs)
    want = [r for r in rows if (r[1] or "").strip()]
    assert bag(now) == bag(want)
    docs, now = stage("line_dedup", docs)
    want = plain_line_dedup(want)
    assert bag(now) == bag(want) and (400, rows[3][1]) not in want
    docs, now = stage("jaccard_dedup", docs)
    want = plain_near_copies(want)
    assert bag(now) == bag(want)
    assert sum(i == 7 for i, _ in now) == 2 and sum(300 <= (i or 0) < 305 for i, _ in now) < 5
    docs, now = stage("decontamination", docs)
    want = [(i, t) for i, t in want if passage not in " ".join(re.findall(r"[a-z0-9]+", t.lower()))]
    assert bag(now) == bag(want) and not any(200 <= (i or 0) < 204 for i, _ in now)
    encoder = sentencepieces.Encoder(pieces.load_pieces())
    tokens = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "ids").collect()]
    assert sorted(map(str, tokens)) == sorted(str((i, encoder(t).tolist())) for i, t in want)


def test_pipeline_of_no_rows_and_awkward_rows(spark, tmp_path):
    for name, docs in (("none", awkward(spark).where("false")), ("some", awkward(spark))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        docs.selectExpr("doc_id as item_id", "text").where("doc_id = 5").write.parquet(f"{folder}/benchmark.parquet")
        docs.selectExpr("doc_id as page_id", "text as url", "text as html").write.parquet(f"{folder}/pages.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == ["doc_id", "n_tokens", "ids", "lossless"]
        assert out.count() == 0 if name == "none" else out.count() <= docs.count()


def test_near_copies_of_repeated_and_missing_ids(spark):
    """An id with two texts is two documents; repeated rows are one; a nameless copy goes, also beside others."""
    text = lambda c: " ".join(f"{c}{i}" for i in range(60))
    rows = [(5, text("a")), (5, text("b")), (9, text("c")), (9, text("c")), (None, text("a")), (None, text("d")), (None, text("d") + " x"), (6, text("b") + " y")]
    docs = table(spark, rows).select(*DOCUMENT_COLUMNS)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.jaccard_dedup(spark, docs, "").collect()]
    named = [(5, text("a")), (5, text("b")), (9, text("c"))]
    assert sorted(g for g in got if g[0] is not None) == named
    nameless = [t for i, t in got if i is None]
    assert len(nameless) == 1 and nameless[0].startswith("d0")


def near_copies_left(texts, words=5, percent=80):
    """Ids that stay if each group of near copies keeps its smallest, by all pairs; texts is {id: text}."""
    sets, root = {}, {i: i for i in texts}
    for i, t in texts.items():
        w = t.lower().split()
        sets[i] = {tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()
    links = []
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            links.append((a, b))
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return sorted(i for i in root if root[i] == i)


def test_pipeline_near_copies_against_all_pairs(spark):
    random = np.random.default_rng(8)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base), " ".join(base + [f"z{i}" for i in range(20)])]  # 96/116 = 0.828, on four words 97/117 = 0.829
    for i in range(60):
        if i % 6 == 0:
            base = [f"v{x}" for x in random.integers(0, 5000, random.integers(4, 150))]
        texts.append(" ".join(base + [f"y{i}-{x}" for x in range(len(base) * (i % 6) // 20)]))
    texts = dict(enumerate(texts))
    docs = table(spark, list(texts.items())).select(*DOCUMENT_COLUMNS)
    left = sorted(r.doc_id for r in corpus_pipeline.jaccard_dedup(spark, docs, "").select("doc_id").collect())
    assert left == near_copies_left(texts) and 1 not in left
    assert left != near_copies_left(texts, 4, 85)


SPLIT = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())


def contained_in(templates, texts, share=0.8):
    """{id: {license: containment}} by counting all three-word shingles."""
    cut = lambda w: {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))}
    whole = [(name, cut(SPLIT(t))) for name, t in templates]
    out = {}
    for i, t in texts:
        mine = cut(SPLIT(t))
        out[i] = {name: len(s & mine) / len(s) for name, s in whole if len(s & mine) >= share * len(s)}
    return out


def test_changed_licences_against_brute_force(spark):
    random = np.random.default_rng(11)
    texts = []
    for i in range(4000):
        w = SPLIT(licenses.TEMPLATES[i % len(licenses.TEMPLATES)][1])
        if i % 3:
            w[random.integers(0, len(w))] = f"changed{i}"
        around = [f"r{x}" for x in random.integers(0, 10**6, 30)]
        at = random.integers(0, 31)
        texts.append((i, " ".join(around[:at] + w + around[at:])))
    wanted = {(i, name) for i, names in contained_in(licenses.TEMPLATES, texts).items() for name in names}
    got = {(r.doc_id, name) for r in licenses.scan(table(spark, texts)).collect() for name in r.licenses}
    assert got <= wanted and len(got) >= 0.995 * len(wanted)


def test_whole_licences_from_files(spark, tmp_path):
    random = np.random.default_rng(12)
    prose = lambda n: " ".join(f"v{x}" for x in random.integers(0, 400, n))
    templates = [(f"L-{i}.0", prose(n)) for i, n in enumerate((40, 200, 900))]
    for name, text in templates:
        (tmp_path / f"{name}.txt").write_text(text.replace(" v7", "\nv7"))
    texts = []
    for i in range(300):
        w = templates[i % 3][1].split()
        for at in random.integers(0, len(w), len(w) * (i % 5) // 30):
            w[at] = f"new{i}"
        texts.append((i, f"{prose(50)} {' '.join(w)} {prose(50)}".upper()))
    wanted = {(i, n) for i, names in contained_in(templates, texts).items() for n in names}
    out = licenses.scan(table(spark, texts), licenses.read_templates(spark, str(tmp_path))).collect()
    got = {(r.doc_id, name) for r in out for name in r.licenses}
    assert got == wanted and 100 < len(got) < 300
    for r in out:
        if r.licenses:
            assert r.containment == pytest.approx(max(contained_in(templates, [texts[r.doc_id]])[r.doc_id].values()))


def test_licences_come_through_their_bands(spark, monkeypatch):
    docs = table(spark, [(1, licenses.TEMPLATES[1][1])])
    assert licenses.scan(docs).first().licenses == ["MIT"]
    chunks = licenses.template_chunks
    monkeypatch.setattr(licenses, "template_chunks", lambda t: (chunks(t)[0].where("false"), chunks(t)[1]))
    assert licenses.scan(docs).first().licenses == []


def test_fused_posterior_against_brute_force(spark, medium):
    """Hosts, suffixes and declarations, absent ones too, from pages; the posterior by hand."""
    docs = spark.read.parquet(f"{medium}/documents.parquet").where("doc_id < 120")
    pages = [(i, f"https://h{i % 7}.{'fr' if i % 3 else 'de'}/a/{i}.html", f"<html class='x' lang='{'xx' if i % 3 else 'en'}'>" if i % 4 else "<p>") for i in range(0, 120, 2)]
    pages += [(500 + i, f"http://other.org/{i}", "") for i in range(0, 60, 3)]  # a later page of the same number
    pages += [(900, "no address", "<html lang=fr>"), (901, None, None)]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    comment = "<!-- " + "x" * 3000 + " -->"
    docs = docs.withColumn("text", F.when(F.expr("doc_id % 5 = 1"), F.concat(F.lit(comment + "<html lang=zz>"), "text")).otherwise(F.col("text")))
    model = language.train(docs.select("text", "lang"))
    rows = {r.doc_id: r for r in language.likelihoods(docs, model, ["doc_id", "source"]).collect()}
    at = {r.doc_id: r for r in language.addresses(pages).collect()}
    assert at[2].host == "h2.fr" and at[2].suffix == "fr" and at[3].host == "other.org"
    met = {}
    for i, r in rows.items():
        own = "zz" if i % 5 == 1 else ""
        a = at.get(i)
        met[i] = (a.suffix if a else "", (a.host if a else "") or r.source, (a.declared if a else "") or own)
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    k = len(model[0]) + 1
    flat = np.array([0.0] * (k - 1) + [np.log(language.UND_PRIOR)])
    alone = {i: softmax(np.array(r.ll) + flat) for i, r in rows.items()}
    seen = [i for i, r in rows.items() if r.n_grams > 0]
    shrink = lambda ids, parent: (sum((alone[i] for i in ids), np.zeros(k)) + language.PSEUDO * parent) / (len(ids) + language.PSEUDO)
    root = sum(alone[i] for i in seen) + 0.5
    root = root / root.sum()
    claimed = [i for i in seen if met[i][2]]
    marks = sum((alone[i] for i in claimed), np.zeros(k))
    out = {r.doc_id: r for r in language.identify_documents(docs, pages).collect()}
    assert len(claimed) > 30 and {met[i][2] for i in claimed} >= {"en", "xx", "zz"}
    for i in seen:
        suffix, host, declared = met[i]
        parent = shrink([j for j in seen if met[j][0] == suffix], root)
        prior = shrink([j for j in seen if met[j][:2] == (suffix, host)], parent)
        score = np.array(rows[i].ll) + np.log(prior)
        if declared:
            same = [j for j in claimed if met[j][2] == declared]
            score = score + np.log((sum(alone[j] for j in same) + len(same) / len(claimed)) / (marks + 1))
        posterior = softmax(score)
        assert out[i].probability == pytest.approx(posterior.max(), rel=1e-6)
        assert out[i].language == [*model[0], language.UND][int(posterior.argmax())]


def test_quality_scores_against_all_pairs(spark, small):
    """The query's scores, from the fitted weights, by the sum over pairs of features; and without labels."""
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    machine, make = quality.train(docs, labels), quality.Features()
    texts = {r.doc_id: r for r in docs.limit(12).collect()}
    got = {r.doc_id: r for r in quality.op10_quality_classifier(spark, small).collect()}
    assert len(got) == docs.count()
    for i, r in texts.items():
        at, x = quality._joined(*make(r.text, r.n_chars))
        products = (machine.v[at] @ machine.v[at].T) * np.outer(x, x)
        raw = machine.bias + machine.w[at] @ x + (products.sum() - np.trace(products)) / 2
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-raw)), rel=1e-6)
        assert got[i].predicted == int(got[i].score >= 0.3)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    none = quality.score(docs, quality.train(docs, labels.where("false"))).collect()
    assert len(none) == len(got) and all(abs(r.score - 0.5) < 0.3 for r in none)


def test_forgotten_words_draw_alike():
    """Words that take each other's places do not change a fingerprint."""
    texts = [" ".join(f"w{x}" for x in np.random.default_rng(i).integers(0, 400, 150)) for i in range(40)]
    plain = fingerprints.Sampler(32)
    want = [(plain(t), plain(fingerprints.edited(t, texts[0]))) for t in texts]
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(fingerprints, "KEPT", 64)
        patched.setattr(fingerprints, "TERMS", 60)
        forgetful = fingerprints.Sampler(32)
        forgetful.memory = fingerprints.Memory(32)
        for t, (one, two) in zip(texts, want, strict=True):
            assert (forgetful(t) == one).all() and (forgetful(fingerprints.edited(t, texts[0])) == two).all()


def test_texts_without_words_have_fingerprints():
    sampler = fingerprints.Sampler(64)
    assert not sampler("").any() and not sampler(None).any()
    assert sampler(" ").any() and (sampler(" ") == sampler(" ")).all()
    assert fingerprints.likeness(sampler(" "), sampler("\n")) < 0.5


def test_fingerprints_of_long_texts_of_many_words():
    sampler = fingerprints.Sampler(512)
    long = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    x, other, half = sampler(long(0, 30_000)), sampler(long(30_000, 60_000)), sampler(long(15_000, 45_000))
    assert fingerprints.likeness(x, other) < 0.02
    assert abs(fingerprints.likeness(x, half) - 1 / 3) < 0.09
    assert (sampler(long(0, 30_000)) == x).all()  # kept words and new ones draw alike


def test_proximity_query_against_plain_search(spark, tmp_path):
    from branchlens.llm.catalog import QUERIES

    random = np.random.default_rng(13)
    passage = [f"p{i}" for i in range(10)]
    items = [(1, " ".join(passage)), (2, "aa bb"), (3, "cc"), (4, "dd ee dd"), (5, None)]
    vocabulary = [*passage, "aa", "bb", "cc", "dd", "ee", *(f"x{i}" for i in range(40))]
    docs = [(i, " ".join(random.choice(vocabulary, 60))) for i in range(30)]
    mixed = [w for x in random.permutation(passage) for w in (x, "between")]
    docs += [(30, " ".join(mixed)), (31, " ".join(["far"] * 30 + passage[:5] + ["far"] * 30 + passage[5:])), (32, None)]
    table(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    split = {i: (t or "").split() for i, t in docs}
    counts = {w: sum(x.count(w) for x in split.values()) for w in vocabulary}
    wanted = {}
    for i, w in split.items():
        places, met = set(), set()
        for item, t in items:
            terms = (t or "").split()
            if terms:
                rarest = min(terms, key=lambda x: (counts[x], terms.index(x)))
                for p in range(len(w)):
                    if w[p] == rarest and set(terms) <= set(w[max(0, p - 20) : p + 21]):
                        places.add(p)
                        met.add(item)
        wanted[i] = (len(w), len(places), len(met))
    got = {r.doc_id: (r.n_words, r.n_near, r.n_near_items) for r in QUERIES["op3_proximity"](spark, str(tmp_path)).collect()}
    assert got == wanted and wanted[30][1] and not wanted[31][1]


def test_archives_of_no_pages_and_of_clashing_columns(spark, tmp_path):
    fields = "page_id long, url string, html string, offset long, payload_digest string, record_type string, part int, path string"
    rows = [(1, "http://a/", "x" * 200, 9, "d", "t", 1, "p"), (2, None, "x" * 200, 9, "d", "t", 1, "p"), (None, "u", None, 9, "d", "t", 1, "p")]
    for name, some in (("none", []), ("some", rows)):
        folder = str(tmp_path / name)
        warc.write_archives(spark.createDataFrame(some, fields), folder)
        got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(spark, folder).collect()]
        want = [(1, 200, "response", None), (2, 200, "revisit", 1), (None, 0, "response", None)] if some else []
        assert sorted(got, key=str) == sorted(want, key=str)


def test_proximity_of_no_rows(spark):
    docs, items = awkward(spark), spark.createDataFrame([(1, "shared line"), (2, None)], "item_id long, text string")
    assert decontam.proximity(docs.where("false"), items).count() == 0
    assert {r.n_near for r in decontam.proximity(docs, items.where("false")).collect()} == {0}
    assert decontam.proximity(docs, items).count() == docs.count()


def test_ends_of_documents_are_no_single_key(spark):
    """More documents than kinds of ends; every one is found again, with its words."""
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('alpha beta ', id) as text")
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    out = decontam.contamination(docs, items)
    assert out.where("n_words = 3 and n_hit = 2").select("doc_id").distinct().count() == 3000
