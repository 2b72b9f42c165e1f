"""Near-duplicates by MinHash with sequential Bayesian verification.

Documents with the same shingle set are one class. Signatures of classes meet in
band buckets. There they are compared batch by batch; after each batch a pair is
given up if, under a uniform prior, the posterior probability that its similarity
reaches the threshold is below the chosen miss probability. Pairs that stay tie
classes to candidate clusters, and inside a cluster the survivors of the same test
are verified on full sets. Only ties that join something new leave a task, so a
group of copies costs links in proportion to its size, not to its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.components import components
from logtide.llm.words import BASE_1, WindowHashes, arrow_map, mixed, released, utf8, word_hashes
from logtide.llm.workspace import Workspace

BANDS, ROWS = 25, 4
BATCH = 20
MISS_PROBABILITY = 1e-9
# A block of a bucket or cluster: rows, and bytes of what its task holds of them.
BLOCK_ROWS, BLOCK_BYTES = 2048, 32 << 20
# One row in so many of a block represents its key in all blocks.
REPRESENTATIVE = 16
# Rows without an id get numbers from here on.
_NO_ID = 1 << 62
_CHUNK = 1 << 14


def _factors(count: int) -> np.ndarray:
    """Odd 64-bit multipliers, one hash function each."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(BASE_1)) | np.uint64(1)


def shingle_set(words: list[bytes], width: int, hashes: WindowHashes) -> np.ndarray:
    """Sorted distinct hashes of the windows of ``width`` words, or of all words if
    there are fewer; none without words."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    return np.unique(hashes.at(word_hashes(words), width, np.arange(len(words) - width + 1)))


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest upper half of every hash function's values."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), _CHUNK):
        np.minimum(least, (shingles[lo : lo + _CHUNK, None] * factors).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def least_matches(size: int, batch: int, threshold: float, miss: float) -> list[int]:
    """Per batch end, the fewest equal hashes with which a pair goes on.

    With a uniform prior and ``m`` of ``n`` equal, similarity reaches the threshold
    with the probability that a binomial of ``n + 1`` draws is at most ``m``.
    """
    bounds = []
    for n in range(batch, size + 1, batch):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        bounds.append(m)
    return bounds


class _Forest:
    """Union-find over row numbers of a task."""

    def __init__(self, labels: np.ndarray):
        _, self.label = np.unique(labels, return_inverse=True)

    def join(self, a: int, b: int) -> None:
        self.label[self.label == self.label[b]] = self.label[a]


class PairTest:
    """The sequential test of one signature against many."""

    def __init__(self, size: int, batch: int, threshold_percent: int, miss: float):
        self._batch, self._percent = batch, threshold_percent
        self._bounds = least_matches(size, batch, threshold_percent / 100, miss)

    def survivors(self, signatures: np.ndarray, sizes: np.ndarray, row: int, others: np.ndarray) -> np.ndarray:
        """Rows of ``others`` that may reach the threshold with ``row``, likeliest first."""
        low = np.minimum(sizes[others], sizes[row]).astype(np.int64)
        high = np.maximum(sizes[others], sizes[row]).astype(np.int64)
        others = others[100 * low >= self._percent * high]
        matches = np.zeros(len(others), np.int64)
        for k, bound in enumerate(self._bounds):
            if not len(others):
                break
            part = slice(k * self._batch, (k + 1) * self._batch)
            matches += (signatures[others, part] == signatures[row, part]).sum(axis=1)
            stay = matches >= bound
            others, matches = others[stay], matches[stay]
        return others[np.argsort(-matches, kind="stable")]


def _tie(crossing, labels, side, test: PairTest, signatures, sizes, verify) -> Iterator[tuple[int, int]]:
    """Ties between rows of different components, until no pair can join more.

    ``crossing`` compares rows of different ``side`` only. ``verify`` tells which
    survivors are links.
    """
    forest = _Forest(labels)
    rows = np.arange(len(labels))
    for row in rows:
        others = rows[row + 1 :]
        others = others[(forest.label[others] != forest.label[row])]
        if crossing:
            others = others[side[others] != side[row]]
        if not len(others):
            continue
        for other in verify(row, test.survivors(signatures, sizes, row, others), forest):
            if forest.label[row] != forest.label[other]:
                forest.join(row, other)
                yield row, other


def _with_blocks(counts: DataFrame, config: dict) -> DataFrame:
    """``n_blocks`` for ``key_rows`` rows of ``key_bytes`` bytes in all."""
    fill = F.greatest(F.col("key_rows") / config["block_rows"], F.col("key_bytes") / config["block_bytes"])
    return counts.withColumn("n_blocks", F.ceil(fill).cast("int"))


def _compared(rows: DataFrame, key: str, size: int, config: dict, exact: bool) -> DataFrame:
    """Ties found within each (key, part, other): tentative, or verified on sets.

    Rows with ``side`` 0 are compared with rows of ``side`` 1; those with -1 with each other.
    """
    percent = config["threshold_percent"]
    # Its bounds cost more than the comparisons of a small group, so all groups share it.
    test = PairTest(size, config["batch"], percent, config["miss"])

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cls", "ascending")])
        cls = table["cls"].to_numpy()
        sizes = table["n"].to_numpy()
        signatures = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(-1, size)
        side = table["side"].to_numpy()
        if exact:
            sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
            check = _exact(sets, sizes, percent)
        else:
            check = lambda row, survivors, forest: survivors.tolist()
        ties = list(_tie(side[0] >= 0, table["label"].to_numpy(), side, test, signatures, sizes, check))
        return pa.table(
            {
                "a": pa.array([cls[a] for a, _ in ties], pa.int64()),
                "b": pa.array([cls[b] for _, b in ties], pa.int64()),
            }
        )

    return rows.groupBy(key, "part", "other").applyInArrow(released(compare), "a long, b long")


def _in_blocks(
    rows: DataFrame, counts: DataFrame, key: str, size: int, config: dict, work: Workspace, exact: bool
) -> DataFrame:
    """Edges that connect what ties between any two rows of a key connect.

    ``counts`` tells the ``n_blocks`` of each key. A key of one block is one task. A
    larger one is dealt to blocks by a hash. Each block first meets itself and the
    representatives of the key, one row in ``REPRESENTATIVE`` of a block, so copies of
    one text are joined in proportion to their number. What these ties connect to the
    key's main component is not compared again; the rest, and only the rest, then meets
    all rows of the key, block by block.
    """
    held = ["cls", "n", "sig", "label", *(["shingles"] if exact else [])]
    whole = rows.join(counts.where("n_blocks = 1 AND key_rows > 1"), key).select(
        key, *held, F.lit(0).alias("part"), F.lit(0).alias("other"), F.lit(-1).alias("side")
    )
    ties = _compared(whole, key, size, config, exact)
    hot_keys = counts.where("n_blocks > 1")
    if hot_keys.isEmpty():
        return ties
    own = F.pmod(F.xxhash64("cls"), F.col("n_blocks")).cast("int")
    hot = work.saved(
        rows.join(hot_keys, key).select(key, *held, "key_rows", "n_blocks", own.alias("own")), f"{key}-hot"
    )
    every = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    stands_for = F.pmod(F.xxhash64("cls", F.lit(REPRESENTATIVE)), F.col("n_blocks") * REPRESENTATIVE) == 0
    met = hot.select(
        key, *held, F.explode(F.when(stands_for, every).otherwise(F.array("own"))).alias("part"),
        F.lit(0).alias("other"), F.lit(-1).alias("side"),
    )
    first = ties.unionByName(_compared(met, key, size, config, exact))
    joined = components(first, work, f"{key}-first")
    edges = joined.select(F.col("node").alias("a"), F.col("label").alias("b"))

    known = joined.select(F.col("node").alias("cls"), F.col("label").alias("joined"))
    labelled = hot.join(known, "cls", "left").withColumn("label", F.coalesce("joined", "label")).drop("joined")
    by_label = labelled.groupBy(key, "label").agg(F.count("*").alias("n_label"))
    main = work.saved(
        by_label.groupBy(key).agg(
            F.max(F.struct("n_label", "label"))["label"].alias("main"),
            (F.sum("n_label") - F.max("n_label")).alias("n_rest"),
        ).where("n_rest > 0"),
        f"{key}-main",
    )
    if main.isEmpty():
        return edges
    n_parts = F.ceil(F.col("n_rest") * F.col("n_blocks") / F.col("key_rows")).cast("int")
    left_open = labelled.join(main, key).withColumn("n_parts", n_parts)
    rest = left_open.where("label <> main").select(
        key, *held, F.pmod(F.xxhash64("cls"), F.col("n_parts")).cast("int").alias("part"),
        F.explode(every).alias("other"), F.lit(0).alias("side"),
    )
    against = left_open.select(
        key, *held, F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("part"),
        F.col("own").alias("other"), F.lit(1).alias("side"),
    )
    return edges.unionByName(_compared(rest.unionByName(against), key, size, config, exact))


def _exact(sets: list[np.ndarray], sizes: np.ndarray, percent: int):
    """Verifier on full sets; many survivors of a row are counted at once through
    an index from shingle to rows."""
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]

    def linked(row: int, survivors: np.ndarray, forest) -> Iterator[int]:
        mine = sets[row]
        if len(survivors) > 8:
            first, last = np.searchsorted(values, mine), np.searchsorted(values, mine, "right")
            lengths = last - first
            at = np.repeat(first - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
            shared = np.bincount(owners[at], minlength=len(sets))[survivors]
        else:
            shared = np.array(
                [np.count_nonzero(_member(sets[o], mine)) for o in survivors], np.int64
            )
        union = sizes[row] + sizes[survivors] - shared
        return iter(survivors[100 * shared >= percent * union].tolist())

    return linked


def _member(values: np.ndarray, within: np.ndarray) -> np.ndarray:
    at = np.searchsorted(within, values)
    return within[np.minimum(at, len(within) - 1)] == values


def near_duplicates(
    docs: DataFrame,
    work: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    threshold_percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    miss: float = MISS_PROBABILITY,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, row_fp, n_shingles, component_id, kept, group_no``.

    Words are runs of characters other than white space (0x20, 0x09-0x0D), A-Z in
    lower case. Documents are linked if ``100 * intersection >= threshold_percent *
    union`` of their distinct shingles; a text with fewer words is one shingle, one
    without words is empty and linked with nothing. ``component_id`` is the smallest
    id reachable over links, ``kept`` marks the document that has it. Rows that
    share an id with other texts are documents of their own, and may have one
    ``component_id`` without being linked; ``group_no`` tells groups of linked texts
    apart and is null without words. Equal rows all have a row here. A row without
    an id has its own place: its ``component_id`` is null unless a row with an id is
    reachable, and it is kept only if there is none. A pair at the threshold misses
    every bucket with probability ``(1 - threshold^rows)^bands``.
    """
    size = bands * rows
    config = {
        "threshold_percent": threshold_percent, "miss": miss,
        "block_rows": block_rows, "block_bytes": block_bytes,
        "batch": max(b for b in range(1, BATCH + 1) if size % b == 0),
    }
    text = F.col(f"`{text_col}`").cast("string")
    doc_id, row_fp = F.col(f"`{id_col}`").cast("long"), F.xxhash64(text)
    node = F.coalesce(doc_id, F.lit(_NO_ID) + F.pmod(row_fp, F.lit(1 << 61)))
    source = docs.select(
        doc_id.alias("doc_id"), row_fp.alias("row_fp"), node.alias("node"), text.alias("text")
    )

    def sets_of(texts) -> Iterator[tuple[np.ndarray, int, int]]:
        hashes = WindowHashes(BASE_1)
        for value in texts:
            shingles = shingle_set(value.lower().split() if value else [], shingle_words, hashes)
            digest = xxhash.xxh3_128_digest(shingles.tobytes())
            yield (
                shingles,
                int.from_bytes(digest[:8], "little", signed=True),
                int.from_bytes(digest[8:], "little", signed=True),
            )

    def signed(batches) -> Iterator[dict]:
        factors = _factors(size)
        for batch in batches:
            found = list(sets_of(utf8(batch.column(3))))
            yield {
                "doc_id": batch.column(0), "row_fp": batch.column(1), "node": batch.column(2),
                "n": [len(s) for s, _, _ in found],
                "k1": [a for _, a, _ in found], "k2": [b for _, _, b in found],
                "sig": [signature(s, factors).tobytes() if len(s) else None for s, _, _ in found],
            }

    documents = work.saved(
        arrow_map(source, signed, "doc_id long, row_fp long, node long, n long, k1 long, k2 long, sig binary"),
        "signatures",
    )
    classes = work.saved(
        documents.where("n > 0").groupBy("k1", "k2")
        .agg(F.min(F.struct("node", "n", "sig")).alias("r"))
        .select("k1", "k2", "r.node", "r.n", "r.sig", F.monotonically_increasing_id().alias("cls")),
        "classes",
    )

    def banded(batches) -> Iterator[dict]:
        number = np.arange(bands, dtype=np.uint64)
        for batch in batches:
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32)
            parts = sigs.reshape(-1, bands, rows).astype(np.uint64)
            value = np.broadcast_to(number, parts.shape[:2]).copy()
            for k in range(rows):
                value = mixed(value * np.uint64(BASE_1) + parts[:, :, k])
            yield {"cls": batch.column(0), "buckets": list(value.astype(np.int64))}

    placed = arrow_map(classes.select("cls", "sig"), banded, "cls long, buckets array<long>").select(
        "cls", F.explode("buckets").alias("bucket")
    )
    shared = placed.groupBy("bucket").agg(F.count("*").alias("key_rows")).where("key_rows > 1")
    buckets = work.saved(
        _with_blocks(shared.withColumn("key_bytes", F.col("key_rows") * (4 * size)), config), "buckets"
    )
    met = placed.join(buckets.select("bucket"), "bucket", "left_semi")
    members = met.join(classes.select("cls", "n", "sig", F.col("cls").alias("label")), "cls")
    tentative = _in_blocks(members, buckets, "bucket", size, config, work, exact=False)
    clusters = work.saved(components(tentative, work, "clusters"), "clusters")

    wanted = classes.join(clusters.withColumnRenamed("node", "cls"), "cls").select(
        "cls", F.col("label").alias("cluster"), F.col("node").alias("first_node"),
        F.col("k1").alias("want_1"), F.col("k2").alias("want_2"),
    )
    texts = source.join(wanted, source.node == wanted.first_node).select(
        "cls", "cluster", "want_1", "want_2", "text"
    )

    def full(batches) -> Iterator[dict]:
        factors = _factors(size)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:4]]
            out: dict[str, list] = {"cls": [], "cluster": [], "n": [], "sig": [], "shingles": []}
            found = sets_of(utf8(batch.column(4)))
            for cls, cluster, want_1, want_2, (shingles, k1, k2) in zip(*columns, found, strict=True):
                if (k1, k2) == (want_1, want_2):
                    values = (cls, cluster, len(shingles), signature(shingles, factors).tobytes(), shingles.tobytes())
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
            yield out

    sets = work.saved(
        arrow_map(texts, full, "cls long, cluster long, n long, sig binary, shingles binary")
        .dropDuplicates(["cls"])
        .withColumn("label", F.col("cls")),
        "sets",
    )
    totals = sets.groupBy("cluster").agg(
        F.count("*").alias("key_rows"), F.sum(F.col("n") * 8).alias("key_bytes")
    )
    totals = work.saved(_with_blocks(totals, config), "totals")
    links = _in_blocks(sets, totals, "cluster", size, config, work, exact=True)
    joined = components(links, work, "links").select(
        F.col("node").alias("cls"), F.col("label").alias("component")
    )
    labels = classes.select("k1", "k2", "node", "cls").join(joined, "cls", "left").select(
        F.col("k1").alias("class_1"), F.col("k2").alias("class_2"),
        F.col("node").alias("first_node"), F.coalesce("component", "cls").alias("component"),
    )
    smallest = labels.groupBy("component").agg(F.min("first_node").alias("least_node"))
    labels = labels.join(smallest, "component").select(
        "class_1", "class_2", "least_node", F.col("component").alias("group_no")
    )
    same = (documents.k1 == labels.class_1) & (documents.k2 == labels.class_2) & (documents.n > 0)
    component = F.coalesce("least_node", "node")
    return documents.join(labels, same, "left").select(
        "doc_id", "row_fp", F.col("n").alias("n_shingles"),
        F.when(component < _NO_ID, component).alias("component_id"),
        (F.col("node") == component).alias("kept"), "group_no",
    )
