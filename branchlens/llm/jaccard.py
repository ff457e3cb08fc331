"""Operator 5: n-gram Jaccard join with PartEnum signatures, as linked groups of documents.

Method: sets are cut into size bands. Within a band, linked sets differ in at most k
shingles. The shingle domain is hashed into groups of three partitions each, with so many groups that at
least one holds at most one of the k differences; so two of its three partitions are
equal in both sets. Each set emits a signature for every subset of two partitions of every
group that is not empty (see Partitions), and linked sets share one. A set emits for its own
band and, if it may have a larger partner there, for the next. Where k is 0, linked sets are
equal and need no signature.

Sets that share a signature are compared with the smallest of them first; what remains
unconnected after that is compared member by member, so no link is lost, while a large group
of copies costs one comparison per member. Comparisons count common 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.llm.common import chunks, components, forget, join_hot, mix, read, small, small_batches, staged

WORDS, PERCENT = 4, 85
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2^64
UNBASE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
TURNS = 8  # see Partitions
WIDE = 85  # percent from which bands of two steps give fewer signatures
PART = 1 << 19  # bytes of text worked on at once, or one longer text
SIGNATURES = 1 << 20  # grouped at once in a task
RUN = 4096  # sets of one signature that one task compares; larger runs are cut finer


def _accumulated(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, U64), np.full(n, UNBASE, U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_usual = lru_cache(maxsize=1)(_accumulated)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and its inverse; kept for texts of usual length only."""
    return _usual(PART) if n <= PART else _accumulated(n)


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of texts that lie end to end, and the words before each text.

    Words are runs without blanks (0x20, 0x09-0x0D); A-Z count as a-z.
    """
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    new = np.zeros(len(data) + 1, dtype=bool)
    new[edges] = True
    start = np.flatnonzero(solid & (new[:-1] | ~np.concatenate(([False], solid[:-1]))))
    end = np.flatnonzero(solid & (new[1:] | ~np.concatenate((solid[1:], [False])))) + 1
    up, down = _powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, U64), np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)])))
    hashes = mix((sums[end] - sums[start]) * down[start])
    return hashes, np.searchsorted(start, edges)


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than n words are one shingle."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        yield from (np.zeros(0, U64) for _ in range(len(texts)))
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    h, at = word_hashes(data, offsets - offsets[0])
    with np.errstate(over="ignore"):
        full = h[: max(0, len(h) - n + 1)].copy()
        for i in range(1, n):
            full = mix(full * BASE + h[i : i + len(full)])
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= n:
                yield np.unique(full[a : b - n + 1])
            elif b > a:
                one = np.array([b - a], U64)
                for x in h[a:b]:
                    one = mix(one * BASE + x)
                yield one
            else:
                yield np.zeros(0, U64)


def set_key(s: np.ndarray) -> int:
    """One 64-bit number for a set; 0 for the empty one."""
    with np.errstate(over="ignore"):
        return int((np.bitwise_xor.reduce(mix(s)) * BASE + np.sum(mix(s ^ BASE)) + U64(len(s))).view(np.int64)) if len(s) else 0


def sketch(s: np.ndarray) -> np.ndarray:
    """Sums of the shingles per bucket, modulo 256; about one bucket for every two shingles.

    A shingle changes one bucket, so sets that differ in k shingles differ in k buckets at
    most. Folding the halves gives the sketch for half as many buckets.
    """
    m = 1 << max(3, int(len(s) // 2).bit_length())
    out = np.zeros(m, np.uint8)
    np.add.at(out, (s & U64(m - 1)).astype(np.int64), (s >> U64(56)).astype(np.uint8) | np.uint8(1))
    return out


def fold(x: np.ndarray, m: int) -> np.ndarray:
    while len(x) > m:
        x = x[: len(x) // 2] + x[len(x) // 2 :]
    return x


class Bands:
    """Size bands for a similarity in percent, and each band's partitions.

    A band spans one or two steps of the similarity, so partners are in the same or the next one. Wide
    bands give sets fewer roles, narrow ones fewer signatures a role; which is better depends on the similarity.
    """

    def __init__(self, percent: int):
        self.percent, self.low = percent, [1]
        self.steps = 2 if percent >= WIDE else 1

    def _grow(self, n: int) -> None:
        while self.low[-1] <= n:
            top = self.low[-1]
            for _ in range(self.steps):  # the smallest size out of reach of all sizes below top
                top = max(top + 1, (top - 1) * 100 // self.percent + 1)
            self.low.append(top)

    def roles(self, n: int) -> list[int]:
        self._grow(n * 2 + 2)
        band = int(np.searchsorted(self.low, n, side="right")) - 1
        return [band, band + 1] if n * 100 >= self.percent * self.low[band + 1] else [band]

    def differences(self, band: int) -> int:
        """Most shingles in which linked sets differ if the larger one is in this band."""
        while len(self.low) <= band + 1:
            self._grow(self.low[-1])
        top = self.low[band + 1] - 1
        return 2 * (100 - self.percent) * top // (100 + self.percent)

    @lru_cache(maxsize=256)  # noqa: B019  one object per task
    def plan(self, band: int) -> "Partitions | None":
        """How the band's domain is split; None where linked sets are equal and need no signature."""
        k = self.differences(band)
        if k == 0:
            return None
        smallest = max(1, -(-self.percent * self.low[band] // 100))
        largest = self.low[band + 1] - 1
        usual = int(smallest * (largest / smallest) ** 0.25)
        return Partitions(band, k // 2 + 1, usual)

    def signatures(self, s: np.ndarray) -> np.ndarray:
        plans = filter(None, map(self.plan, self.roles(len(s))))
        return np.concatenate([np.zeros(0, U64), *(x for plan in plans for x in plan.signatures(s))])


def _spare(need: int, size: int) -> int:
    """Spare groups that make the signatures of sets of a size fewest, further turns included."""

    def cost(spare: int) -> float:
        groups = need + spare
        hollow = min(1 - 1e-9, 3 * (1 - 2 / (3 * groups)) ** size)  # a group shows an empty pair
        # At most ``spare`` of the groups do: a binomial distribution.
        few = sum(
            exp(lgamma(groups + 1) - lgamma(i + 1) - lgamma(groups - i + 1) + i * log(hollow) + (groups - i) * log1p(-hollow))
            for i in range(spare + 1)
        )
        return groups / max(few, 1e-3)

    step = 1 + need // 64
    return min(range(0, need + step, step), key=cost)


class Partitions:
    """A band's domain in groups of three partitions; pairs of a group's partitions make signatures.

    An empty pair is the same in all sets, so it makes no signature as long as that loses no link. ``need`` groups are
    enough for linked sets to agree in a pair of one of them; ``spare`` more make it one
    more each. So if a set has an empty pair in ``spare`` groups at most, it agrees
    with each linked set in a pair that is not empty, and both emit that one. A set with empty
    pairs in more groups takes another turn with the domain dealt anew. Linked sets either meet at the
    first turn that ends for one of them or both take the last, which emits empty pairs too
    and which hardly any set reaches.
    """

    def __init__(self, band: int, need: int, size: int):
        self.spare = _spare(need, size)
        self.groups = need + self.spare
        self.band = band

    @lru_cache(maxsize=TURNS)  # noqa: B019  one object per task
    def _marks(self, turn: int) -> tuple[np.uint64, np.ndarray]:
        count = self.groups * 3
        with np.errstate(over="ignore"):
            marks = mix((np.arange(count + 1, dtype=U64) + U64(1)) * BASE + U64(self.band * TURNS + turn + 1))
        return marks[0], marks[1:].reshape(-1, 3)

    def signatures(self, s: np.ndarray) -> Iterator[np.ndarray]:
        for turn in range(TURNS):
            seed, marks = self._marks(turn)
            with np.errstate(over="ignore"):
                x = mix(s + seed)
                sums = np.zeros(self.groups * 3, U64)
                np.add.at(sums, (x % U64(len(sums))).astype(np.int64), mix(x))
                sums = sums.reshape(-1, 3)
                pairs = sums.sum(axis=1, keepdims=True, dtype=U64) - sums
                full = pairs != 0
                signs = mix(pairs + marks)
            ends = (~full.all(axis=1)).sum() <= self.spare
            if not ends and turn == TURNS - 1:
                yield signs.ravel()
                return
            yield signs[full]
            if ends:
                return


SETS = "doc_id long, th long, n_shingles long, key long, sketch binary"
SIGNS = "sig long, key long, more array<long>"


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, size=PART):
                sizes, keys, sketches = [], [], []
                for s in shingle_sets(part.column("text"), n):
                    sizes.append(len(s))
                    keys.append(set_key(s))
                    sketches.append(sketch(s).tobytes() if len(s) else b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("th"), pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.int64()), pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "th", "n_shingles", "key", "sketch"],
                )
        forget()

    return run


def _signs(n: int, percent: int):
    """(sig, key, more): a signature, the smallest set at hand that has it, the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        bands = Bands(percent)
        keys: list[np.ndarray] = []
        signs: list[np.ndarray] = []
        seen: set[int] = set()
        held = 0
        for batch in batches:
            for part in chunks(batch, size=PART):
                for s in shingle_sets(part.column("text"), n):
                    key = set_key(s)
                    if len(s) and key not in seen:  # copies have the same signatures
                        seen.add(key)
                        mine = bands.signatures(s)
                        signs.append(mine)
                        keys.append(np.full(len(mine), key, np.int64))
                        held += len(mine)
                if held >= SIGNATURES:
                    yield _grouped(np.concatenate(signs).view(np.int64), np.concatenate(keys))
                    keys, signs, seen, held = [], [], set(), 0
        if held:
            yield _grouped(np.concatenate(signs).view(np.int64), np.concatenate(keys))
        forget()

    return run


def _grouped(sig: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    rest = np.ones(len(sig), dtype=bool)
    rest[first] = False
    ends = np.concatenate((first[1:], [len(sig)])) - first - 1
    more = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(ends))), pa.int32()), pa.array(key[rest])
    )
    return pa.RecordBatch.from_arrays([pa.array(sig[first]), pa.array(key[first]), more], names=["sig", "key", "more"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by signature: (sig, pivot, keys) where several sets share it.

    ``pivot`` is the first set of the signature, ``keys`` the others of one incoming row, so
    a row stays small however many sets share a signature. A row of its pivot's own batch
    may repeat it.
    """
    sig_now, pivot = None, 0
    for batch in batches:
        sig = batch.column("sig").to_numpy()
        key = batch.column("key").to_numpy()
        more = batch.column("more")
        counts = np.diff(more.offsets.to_numpy())
        same = np.concatenate(([len(sig) > 0 and sig_now is not None and sig[0] == sig_now], sig[1:] == sig[:-1]))
        heads = np.flatnonzero(~same)
        of = np.cumsum(~same) - 1
        pivots = np.where(of >= 0, key[heads][np.maximum(of, 0)] if len(heads) else pivot, pivot)
        alone = ~same & (counts == 0)
        at = np.flatnonzero(~alone)
        if len(at):
            lists = [
                ([] if key[i] == pivots[i] else [key[i]]) + more[int(i)].as_py() if counts[i] else ([] if key[i] == pivots[i] else [key[i]])
                for i in at
            ]
            kept = [(i, x) for i, x in zip(at, lists, strict=True) if x]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(sig[i]) for i, _ in kept], pa.int64()),
                    pa.array([int(pivots[i]) for i, _ in kept], pa.int64()),
                    pa.array([x for _, x in kept], pa.list_(pa.int64())),
                ],
                names=["sig", "pivot", "keys"],
            )
        if len(sig):
            sig_now, pivot = sig[-1], pivots[-1]


def _linked(percent: int):
    """Pairs with both shingle sets: those that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep: list[bool] = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _arrays(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, size=PART):
                sets = list(shingle_sets(part.column("text"), n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["key", "shingles"],
                )

    return run


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) of sets that are linked; the shingles are made anew from the texts at hand."""
    keys = staged(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), "pair-keys")
    ids = reps.join(small(keys), "key", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.join(small(ids.withColumnRenamed("doc_id", "rep_id")), F.expr("doc_id <=> rep_id"), "left_semi")
    sets = (
        texts.mapInArrow(_arrays(n), "key long, shingles binary")
        .join(small(keys), "key", "left_semi")
        .dropDuplicates(["key"])
    )
    sets = staged(sets, "pair-sets")
    return (
        pairs.select("a", "b")
        .join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")
        .mapInArrow(_linked(percent), "a long, b long")
    )


def _compatible(percent: int):
    """Pairs with both sizes and sketches: those that their sketches do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, n2, x, y in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "xa", "xb")), strict=True):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                m = min(len(x), len(y))
                differ = int((fold(x, m) != fold(y, m)).sum())
                near = 100 * min(n, n2) >= percent * max(n, n2)
                keep.append(near and differ <= (100 - percent) * (n + n2) // (100 + percent))
            yield batch.select(["a", "b", "c"]).filter(pa.array(keep, pa.bool_()))

    return run


def _open_pairs(percent: int, every: bool):
    """Rows sorted by signature with labels and sketches: (sig, a, b) of different labels that may link.

    Of each signature only a forest of the closest pairs that joins its labels, and as (sig, a, null) each
    set that may link to one of another label there: the others will not later, since labels
    only join. Or, where ``every`` is set, all pairs, each at the least of the signatures that
    both sets have in ``sigs``.
    """

    def forest(pairs: list[tuple]) -> list[tuple[int, int]]:
        top: dict[int, int] = {}

        def root(label: int) -> int:
            while (up := top.get(label, label)) != label:
                label = up
            return label

        out = []
        for _, a, b, one, two in sorted(pairs):
            if (one := root(one)) != (two := root(two)):
                top[one] = two
                out.append((a, b))
        return out

    def compare(sig: int, rows: pa.Table) -> list[tuple[int, int | None]]:
        keys, labels, sizes = (rows.column(c).to_numpy() for c in ("key", "label", "n"))
        if (labels == labels[0]).all():
            return []
        order = np.argsort(sizes, kind="stable")
        keys, labels, sizes = keys[order], labels[order], sizes[order]
        sketches = rows.column("sketch").to_pylist()
        sigs = rows.column("sigs").to_pylist() if every else []
        m = min(map(len, sketches))
        x = np.stack([fold(np.frombuffer(sketches[i], np.uint8), m) for i in order])
        tops = np.searchsorted(sizes, sizes * 100 // percent, side="right")
        found, closest, open_ = [], {}, np.zeros(len(keys), dtype=bool)
        for i in range(len(keys) - 1):
            near = slice(i + 1, tops[i])
            other = labels[near] != labels[i]
            if not other.any():
                continue
            differ = (x[near] != x[i]).sum(axis=1)
            fit = np.flatnonzero(other & (differ <= (100 - percent) * (sizes[near] + sizes[i]) // (100 + percent)))
            if len(fit):
                open_[i] = open_[i + 1 + fit] = True
            for j in fit:
                a, b = sorted((int(keys[i]), int(keys[i + 1 + j])))
                if every:
                    if min(set(sigs[order[i]]).intersection(sigs[order[i + 1 + j]])) == sig:
                        found.append((a, b))
                else:
                    one, two = sorted((int(labels[i]), int(labels[i + 1 + j])))
                    new = (int(differ[j]), a, b, one, two)
                    closest[one, two] = min(closest.get((one, two), new), new)
        if every:
            return found
        return forest(list(closest.values())) + [(int(k), None) for k in np.unique(keys[open_])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []  # the run that is being read

        def done() -> list[tuple[int, int, int | None]]:
            rows = pa.Table.from_batches(parts)
            return [(now, a, b) for a, b in compare(now, rows)] if len(rows) > 1 else []

        for batch in batches:
            pairs: list[tuple[int, int, int | None]] = []
            sig = batch.column("sig").to_numpy()
            edges = [0, *(np.flatnonzero(sig[1:] != sig[:-1]) + 1), len(sig)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if sig[a] != now and parts:
                    pairs.extend(done())
                    parts = []
                now = int(sig[a])
                parts.append(batch.slice(a, b - a))
            yield _pairs(pairs)
        if parts:
            yield _pairs(done())

    return run


def _pairs(rows: list[tuple[int, int, int | None]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in rows], pa.int64()) for i in range(3)], names=["sig", "a", "b"])


def _finer(percent: int):
    """Second signatures for sets of an overlong run: equal pieces of their sketches.

    Linked sets of a band differ in at most k buckets, so of k + 1 pieces one is equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            out = {c: [] for c in ("sig", "key", "label", "n", "sketch")}
            for r in batch.to_pylist():
                x = np.frombuffer(r["sketch"], np.uint8)
                for band in bands.roles(r["n"]):
                    least = max(1, bands.low[band] * percent // 100)
                    y = fold(x, 1 << max(3, int(least // 2).bit_length()))
                    pieces = bands.differences(band) + 1
                    for i, piece in enumerate(np.array_split(y, pieces) if pieces <= len(y) else [y[:0]]):
                        text = f"{r['sig']} {band} {i} ".encode() + piece.tobytes()
                        sig = int.from_bytes(blake2b(text, digest_size=8).digest(), "little", signed=True)
                        for c, v in {**r, "sig": sig}.items():
                            out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=batch.schema.remove_metadata())

    return run


def _in_blocks(rows: DataFrame) -> DataFrame:
    """(sig, key) where signatures of over RUN sets are replaced by pairs of blocks of their sets.

    Any two sets of a signature meet in the signature of their two blocks, so none
    of a task's runs holds more than about RUN sets, however many share the signature.
    """
    per_sig = staged(rows.groupBy("sig").agg(F.count("*").alias("members")), "cut-sizes")
    large = per_sig.where(F.col("members") > RUN)
    if large.isEmpty():
        return rows
    total = per_sig.agg(F.sum("members")).first()[0]
    met = join_hot(rows, large, ["sig"], "members", total)
    blocks = F.ceil(F.col("members") / F.lit(RUN // 2))
    mine = met.withColumn("block", F.pmod(F.xxhash64("key"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    pair = F.xxhash64("sig", F.least("block", "other"), F.greatest("block", "other"))
    kept = rows.join(small(large.select("sig")), "sig", "left_anti")
    return kept.select("sig", "key").union(mine.select(pair.alias("sig"), "key"))


def linked_groups(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, detail: bool = False
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) per document.

    A set is the distinct shingles of ``words`` words (runs without blanks, A-Z lowered); a
    shorter text is one shingle. Sets link when 100 * intersection >= percent * union. A null
    text or one without words has an empty set, links with nothing and keeps its own id.
    Each row gives one row, repeated rows too; copies link through their equal set. A row
    without an id takes the smallest id of its group, null if there is none. Other columns
    of the input are not looked at; an empty table gives an empty table. With ``detail`` there
    are also th (xxhash64 of the text) and root, a number of the group, null for an empty set.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    sets = staged(docs.mapInArrow(_sets(words), SETS), "sets")
    total = max(1, sets.count())
    filled = sets.where("n_shingles > 0")
    reps = staged(
        filled.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n")),
        "set-classes",
    )
    runs = staged(
        docs.mapInArrow(_signs(words, percent), SIGNS)
        .repartition("sig")
        .sortWithinPartitions("sig", "key")
        .mapInArrow(_runs, "sig long, pivot long, keys array<long>"),
        "signature-runs",
    )
    stars = (
        runs.select("pivot", F.explode("keys").alias("key"))
        .where("pivot != key")
        .groupBy(F.least("pivot", "key").alias("a"), F.greatest("pivot", "key").alias("b"))
        .agg(F.count("*").alias("c"))
    )
    stars = staged(stars, "stars")
    sketches = filled.select("key", "sketch").dropDuplicates(["key"]).join(reps.select("key", "n"), "key")
    sketches = staged(sketches, "sketches")
    side = lambda c: sketches.select(F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"x{c}"))
    stars = staged(
        stars.join(side("a"), "a").join(side("b"), "b").mapInArrow(_compatible(percent), "a long, b long, c long"),
        "near-stars",
    )
    # First each set with the set that it shares most signatures with.
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a")).select("a", "b")
    first = staged(_verified(docs, reps, best, words, percent), "links")
    labels = components(first, "labels").select(F.col("node").alias("key"), F.col("root").alias("label"))
    # Then signatures of three or more sets that are not all connected yet; of two, the star has both.
    members = runs.select("sig", F.explode(F.concat(F.array("pivot"), "keys")).alias("key"))
    labelled = staged(
        members.distinct().join(labels, "key", "left").select("sig", "key", F.coalesce("label", "key").alias("label")),
        "labelled",
    )
    open_sigs = (
        labelled.groupBy("sig")
        .agg(F.min("label").alias("l1"), F.max("label").alias("l2"), F.count("*").alias("members"))
        .where("l1 != l2 and members > 2")
        .select("sig", "members")
    )
    rows = staged(labelled.join(open_sigs, "sig"), "open-sets")
    in_order = lambda df: df.repartition("sig").sortWithinPartitions("sig")
    fields = ["sig", "key", "label", "n", "sketch"]
    large = rows.where(F.col("members") > RUN)
    if not large.isEmpty():
        cut = large.join(sketches, "key").select(*fields)
        cut = cut.mapInArrow(_finer(percent), cut.schema).select("sig", "key")
        cut = _in_blocks(staged(cut.distinct(), "cut-sets"))
        rows = staged(rows.where(F.col("members") <= RUN).select("sig", "key").union(cut), "open-sets")
    rows = rows.select("sig", "key")  # sketches are added anew each time, so that they move only once
    links, tested = first, best.select("a", "b")
    # As long as it joins anything, the closest pairs that could; then all that are left.
    every = False
    while True:
        labelled = rows.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
        wanted = labelled.join(sketches, "key").select(*fields)
        if every:
            wanted = wanted.join(rows.groupBy("key").agg(F.collect_set("sig").alias("sigs")), "key")
        found = staged(in_order(wanted).mapInArrow(_open_pairs(percent, every), "sig long, a long, b long"), "near-pairs")
        rows = found.where("b is null").select("sig", F.col("a").alias("key"))
        pairs = found.where("b is not null").select("a", "b")
        if every:
            labelled_as = lambda c, of=labels: of.select(F.col("key").alias(c), F.col("label").alias(f"l{c}"))
            others = stars.join(labelled_as("a"), "a", "left").join(labelled_as("b"), "b", "left")
            pairs = pairs.union(others.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"))
        pairs = staged(staged(pairs.distinct(), "near-pairs").join(tested, ["a", "b"], "left_anti"), "open-pairs")
        more = staged(_verified(docs, reps, pairs, words, percent), "links")
        tested = tested.union(pairs)
        joined = not more.isEmpty()
        if joined:
            links = links.union(more)
            labels = components(links, "labels").select(F.col("node").alias("key"), F.col("root").alias("label"))
        if every:
            break
        every = not joined
    found = reps.join(labels, "key", "left").select("key", "rep", "copies", F.coalesce("label", "key").alias("root"))
    least = found.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("sets"))
    per_set = staged(
        join_hot(found, least, ["root"], "sets", total).select("key", "copies", "component_id", "root"), "set-groups"
    )
    out = join_hot(sets.drop("sketch"), per_set, ["key"], "copies", total, "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *(["th", F.when(F.col("n_shingles") > 0, F.col("root")).alias("root")] if detail else []),
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_groups(read(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)
), both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON r.x = d.doc_id
"""
