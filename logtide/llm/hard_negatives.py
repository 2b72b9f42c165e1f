"""Hard negatives by a secondary sort of pair scores.

A pair's score is packed into a key of anchor, descending score, kind and id. Keys are
dealt to tasks by anchor and sorted within them, so an iterator reads an anchor's pairs
from the best on: a positive opens a window of scores below its own, and a negative goes
to every open window that holds its score and is not full. No anchor is held in memory;
what is kept is its few open windows.

Anchors and rows meet in blocks: rows are dealt to groups of bounded size, anchors are
copied to every group, and a task holds the rows of one group while the anchors stream
past. A group sends on only what can still be among the answers, so the sort gets a few
pairs per anchor and group instead of all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import arrow_map
from logtide.llm.workspace import Workspace

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
GROUP_ROWS, SMALL_GROUP_ROWS, SPREAD = 65_536, 1_024, 64
SCORES_AT_ONCE = 2_000_000
_BIGGEST = (1 << 63) - 1
_SIGN = np.uint64(1 << 63)
# Big-endian, so that bytes compare as numbers do. Positives stand before negatives.
_KEY = np.dtype([("anchor", ">u8"), ("fp", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_SENT = "anchor_id long, anchor_fp long, key binary"


def _flipped(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64).view(np.uint64) ^ _SIGN


def packed(anchor: int, fp: int, scores: np.ndarray, kind: int, ids: np.ndarray) -> list[bytes]:
    """Keys that sort by anchor, score from the highest, kind and id."""
    keys = np.empty(len(ids), _KEY)
    keys["anchor"], keys["fp"] = _flipped(np.array([anchor, fp]))
    keys["score"], keys["kind"], keys["id"] = ~_flipped(scores), kind, _flipped(ids)
    data = keys.tobytes()
    return [data[n : n + _KEY.itemsize] for n in range(0, len(data), _KEY.itemsize)]


def unpacked(keys: list[bytes]) -> dict[str, list[int]]:
    rows = np.frombuffer(b"".join(keys), _KEY)

    def signed(values: np.ndarray) -> list[int]:
        return (values.astype(np.uint64) ^ _SIGN).view(np.int64).tolist()

    return {
        "anchor": signed(rows["anchor"]), "fp": signed(rows["fp"]),
        "score": signed(~rows["score"].astype(np.uint64)), "kind": rows["kind"].tolist(),
        "id": signed(rows["id"]),
    }


def _matrix(column: pa.Array, scale: int) -> np.ndarray:
    """Whole numbers ``floor(scale * x)``, a row per vector; short vectors end in zeros.

    They are floats while 53 bits hold them, else Python integers.
    """
    lengths = np.array([len(v) for v in column], np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if len(scaled) and not np.abs(scaled).max() < 2**53:
        scaled = np.array(
            [int(v) * scale if abs(v) >= 2**53 else math.floor(v * scale) for v in values.tolist()], object
        )
    width = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lengths), width), scaled.dtype)
    out[np.arange(width) < lengths[:, None]] = scaled
    return out


def _widened(block: np.ndarray, width: int) -> np.ndarray:
    return np.pad(block, ((0, 0), (0, width - block.shape[1]))) if block.shape[1] < width else block


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers; larger ones stand at the largest."""
    width = max(anchors.shape[1], rows.shape[1], 1)
    anchors, rows = _widened(anchors, width), _widened(rows, width)
    if anchors.dtype != object and rows.dtype != object:
        bound = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * width
        if bound < 2**53:
            return (anchors @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    product = whole(anchors) @ whole(rows).T if anchors.size and rows.size else np.zeros((len(anchors), len(rows)))
    return np.clip(product, -_BIGGEST, _BIGGEST).astype(np.int64)


class _Group:
    """Rows of one group, sorted by id, with labels as numbers."""

    def __init__(self, parts: list[tuple[np.ndarray, list[str], np.ndarray]]):
        width = max(m.shape[1] for *_, m in parts)
        ids = np.concatenate([p[0] for p in parts])
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.rows = np.concatenate([_widened(p[2], width) for p in parts])[order]
        names = [name for p in parts for name in p[1]]
        self.number = {name: n for n, name in enumerate(dict.fromkeys(names))}
        self.labels = np.array([self.number[x] for x in names])[order]

    def best(self, at: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` of ``at`` with the highest scores, ties by id."""
        if len(at) > 4 * count:
            floor = np.partition(values[at], len(at) - count)[len(at) - count]
            at = at[values[at] >= floor]
        return at[np.argsort(-values[at], kind="stable")][:count]


def _met(rows: DataFrame, anchors: DataFrame, groups: int, scale: int, found: Callable) -> DataFrame:
    """``found(group, anchor, scores)`` gives keys, for every anchor and group.

    ``anchors`` has the columns of ``rows`` and ``windows``, scores of known positives.
    """
    fields = ["vec_id", "fp", "label", "vector"]
    dealt = rows.select("grp", F.lit(0).alias("kind"), *fields, F.lit(None).cast("array<long>").alias("windows"))
    copied = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), F.lit(1).alias("kind"),
        *fields, "windows",
    )
    met = dealt.union(copied).repartition(groups, "grp").sortWithinPartitions("grp", "kind")

    def stream(batches) -> Iterator[dict]:
        current, parts, group = None, [], None
        for batch in batches:
            grp, kind = (batch.column(n).to_numpy() for n in (0, 1))
            edges = np.flatnonzero(np.r_[True, (grp[1:] != grp[:-1]) | (kind[1:] != kind[:-1]), True])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                run = batch.slice(a, b - a)
                if grp[a] != current:
                    current, parts, group = grp[a], [], None
                ids, labels = run.column(2).to_numpy(), run.column(4).to_pylist()
                if kind[a] == 0:
                    parts.append((ids, labels, _matrix(run.column(5), scale)))
                    continue
                if group is None and parts:
                    group, parts = _Group(parts), []
                if group is None:
                    continue
                fps, windows = run.column(3).to_pylist(), run.column(6).to_pylist()
                vectors, step = _matrix(run.column(5), scale), max(1, SCORES_AT_ONCE // len(group.ids))
                for first in range(0, len(ids), step):
                    table = scores(vectors[first : first + step], group.rows)
                    sent: dict[str, list] = {"anchor_id": [], "anchor_fp": [], "key": []}
                    for n, values in enumerate(table, first):
                        keys = found(group, (int(ids[n]), fps[n], labels[n], windows[n]), values)
                        sent["key"] += keys
                        sent["anchor_id"] += [int(ids[n])] * len(keys)
                        sent["anchor_fp"] += [fps[n]] * len(keys)
                    yield sent

    return arrow_map(met, stream, _SENT)


def _sorted_keys(keys: DataFrame) -> DataFrame:
    """All keys of an anchor in one task, in order."""
    return keys.repartition("anchor_id", "anchor_fp").sortWithinPartitions("key").select("key")


def _first_positives(keys: DataFrame, count: int) -> DataFrame:
    """The first ``count`` keys of every anchor."""

    def stream(batches) -> Iterator[dict]:
        current, taken = None, 0
        for batch in batches:
            sent: dict[str, list] = {"anchor_id": [], "anchor_fp": [], "key": [], "score": []}
            raw = batch.column(0).to_pylist()
            rows = unpacked(raw)
            for key, anchor, fp, score in zip(raw, rows["anchor"], rows["fp"], rows["score"], strict=True):
                if (anchor, fp) != current:
                    current, taken = (anchor, fp), 0
                if taken < count:
                    taken += 1
                    for name, value in zip(sent, (anchor, fp, key, score), strict=True):
                        sent[name].append(value)
            yield sent

    return arrow_map(_sorted_keys(keys), stream, _SENT + ", score long")


def bounds(score: int, low_percent: int, high_percent: int) -> tuple[int, int]:
    """Scores between the two percentages of a positive's, both included."""
    return -(-low_percent * score // 100), high_percent * score // 100


def mined(keys: DataFrame, count: int, low_percent: int, high_percent: int) -> DataFrame:
    """The streaming half: sorted keys in, negatives of every window out."""

    def stream(batches) -> Iterator[dict]:
        names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        current, windows = None, []
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names}
            rows = unpacked(batch.column(0).to_pylist())
            for anchor, fp, score, kind, other in zip(*rows.values(), strict=True):
                if (anchor, fp) != current:
                    current, windows = (anchor, fp), []
                if kind == 0:
                    windows.append([*bounds(score, low_percent, high_percent), score, other, 0])
                    continue
                for window in windows:
                    low, high, positive_score, positive, rank = window
                    if low <= score <= high and rank < count:
                        window[4] += 1
                        values = (anchor, positive, rank + 1, other, positive_score, score)
                        for name, value in zip(names, values, strict=True):
                            out[name].append(value)
            yield out

    return arrow_map(
        _sorted_keys(keys), stream,
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long,"
        " negative_score long",
    )


def _usable(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        label.cast("string").alias("label"),
        F.col(f"`{vector_col}`").alias("vector"),
        bad.alias("bad"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~F.coalesce("bad", F.lit(True))).drop("bad")


def hard_negatives(
    rows: DataFrame, anchor: Column, work: Workspace, id_col: str = "vec_id",
    vector_col: str = "embedding", label: Column | str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """For every anchor and each of its positives, the hardest negatives.

    ``anchor`` is a condition on the column ``vec_id``. A score is the inner product of
    vectors of whole numbers ``floor(scale * x)``, exact; the higher comes first, ties by
    the smaller id. Positives are the first rows of the anchor's label under another id,
    negatives the first rows of other labels whose score is between the two percentages
    of the positive's, both included. Fewer are fewer: an anchor without positives, or a
    positive without negatives, gives no row.

    Rows with a null id, label or vector, or a component that is null or not finite, take
    no part. Shorter vectors count as ended by zeros, an empty vector scores 0 with all.
    Scores beyond 64 bits stand at the largest. A repeated row is a partner as often as it
    is there; anchors equal in id, label and vector are one, and anchors that share only
    the id are mined each for itself. No rows give no rows; other columns are not read.
    """
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    usable = _usable(rows, id_col, vector_col, label)
    fp = F.xxhash64("label", F.col("vector").cast("array<double>"))
    written = work.saved(
        usable.select("vec_id", "label", "vector", fp.alias("fp"), F.monotonically_increasing_id().alias("row")),
        "rows",
    )
    total = written.count()
    groups = max(1, -(-total // group_rows), min(SPREAD, -(-total // SMALL_GROUP_ROWS)))
    dealt = written.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups).cast("long")).cast("int"))
    anchors = written.where(anchor).select("vec_id", "fp", "label", "vector").dropDuplicates(["vec_id", "fp"])

    def nearest(group: _Group, who: tuple, values: np.ndarray) -> list[bytes]:
        anchor_id, fp, name, _ = who
        at = np.flatnonzero((group.labels == group.number.get(name, -1)) & (group.ids != anchor_id))
        at = group.best(at, values, positives)
        return packed(anchor_id, fp, values[at], 0, group.ids[at])

    def in_windows(group: _Group, who: tuple, values: np.ndarray) -> list[bytes]:
        anchor_id, fp, name, opened = who
        limits = [bounds(score, low_percent, high_percent) for score in set(opened)]
        others = np.flatnonzero(group.labels != group.number.get(name, -1))
        others = others[np.argsort(-values[others], kind="stable")]
        falling = -values[others]
        chosen = set()
        for low, high in limits:
            a, b = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -low, "right")
            chosen.update(range(int(a), int(min(b, a + negatives))))
        at = others[sorted(chosen)]
        return packed(anchor_id, fp, values[at], 1, group.ids[at])

    no_windows = anchors.withColumn("windows", F.lit(None).cast("array<long>"))
    first = work.saved(
        _first_positives(_met(dealt, no_windows, groups, scale, nearest), positives), "positives"
    )
    opened = first.groupBy("anchor_id", "anchor_fp").agg(F.collect_list("score").alias("windows"))
    known = anchors.join(
        opened, (F.col("vec_id") == F.col("anchor_id")) & (F.col("fp") == F.col("anchor_fp"))
    ).drop("anchor_id", "anchor_fp")
    below = _met(dealt, known, groups, scale, in_windows)
    return mined(first.drop("score").union(below), negatives, low_percent, high_percent)
