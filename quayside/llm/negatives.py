"""Hard negatives from vectors in Hilbert-curve order, by zone maps of their Parquet blocks.

Vectors are put in the order of a Hilbert curve through all dimensions, so that neighbours in the order are near each other, and are written
in that order: a segment is one task's stretch of the curve, a block some hundred rows of it, which is one row of a Parquet table with its zone map, the least and
the greatest value of each dimension and of the label. A vector's score with anything in a block lies between two sums of interval
products, which are two matrix products for all anchors and blocks.

A search asks, for each anchor and each of its windows of scores, for the few best rows. The anchor's own segment is read first. What it
gives raises the windows' lower ends, and then only blocks whose bounds reach into a window are read. Anchors travel in groups of neighbours to the segments with blocks
for them; the blocks travel once for each ``GROUPS`` groups. No task holds more than a segment and a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.frames import col
from quayside.llm.registry import query
from quayside.session import checkpoint, scratch_path

#: Components are multiplied by this number and rounded down.
SCALE = 256
#: Bits of a dimension on the curve.
BITS = 4
#: Rows of a block and, about, of a segment.
BLOCK = 256
SEGMENT = 8192
#: Anchors of a group, and groups that share one copy of a segment.
ANCHORS = 64
GROUPS = 1024
#: Stands for a null identifier inside, which comes after all others.
NO_ID = 2**63 - 1

POSITIVES, NEGATIVES = 5, 3
#: A negative's score is between these percentages of the positive's.
LEAST_PERCENT, MOST_PERCENT = 50, 95


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of each row of small numbers on the curve, as bytes whose order is that of the curve."""
    x = cells.T.astype(np.uint8 if bits <= 8 else np.uint32)  # a row per dimension
    one = x.dtype.type(1)
    for bit in range(bits - 1, 0, -1):
        below = x.dtype.type((1 << bit) - 1)
        for i in range(len(x)):
            up = (x[i] >> x.dtype.type(bit) & one).astype(bool)
            swapped = np.where(up, 0, (x[0] ^ x[i]) & below).astype(x.dtype)
            x[0] ^= np.where(up, below, swapped)
            x[i] ^= swapped
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turned = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where(x[-1] >> x.dtype.type(bit) & one, x.dtype.type((1 << bit) - 1), x.dtype.type(0))
    x ^= turned
    planes = [(x >> x.dtype.type(bit) & one).T for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def score_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Between which numbers the inner product of each anchor with anything in each box lies."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _matrix(batch: pa.RecordBatch, dims: int, scale: int) -> np.ndarray:
    """The vectors of a batch as rounded numbers; short ones are filled with zeros."""
    lists = batch.column("vector")
    values = np.floor(np.asarray(lists.flatten(), np.float64) * scale)
    sizes = np.asarray(pa.compute.list_value_length(lists), np.int64)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims)[None, :] < sizes[:, None]] = values
    return out


class Index:
    """The blocks of a table of vectors, in Hilbert order, in Parquet."""

    def __init__(self, spark: SparkSession, path: str, dims: int):
        self.spark, self.path, self.dims = spark, path, dims

    @property
    def blocks(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    @property
    def zones(self) -> DataFrame:
        """The zone maps alone: a hundredth of the blocks' bytes, as the others are not read."""
        return self.blocks.select("segment", "block", "low", "high", "label_low", "label_high")


BLOCKS = (
    "segment int, block int, ids binary, labels binary, vectors binary, anchors binary, "
    "low binary, high binary, label_low bigint, label_high bigint"
)


def build(rows: DataFrame, path: str, scale: int = SCALE, segment_rows: int = SEGMENT, block_rows: int = BLOCK) -> Index:
    """Write the blocks of rows of id, label, vector and whether the row is an anchor.

    Labels and vectors are not null and all components are finite. Vectors shorter than the longest are filled with zeros. Scores
    must be whole numbers below 2**53, so that sums are exact; larger components raise an error.
    """
    spark = rows.sparkSession

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = np.zeros(0)
        n = 0
        for batch in batches:
            dims = max(len(low), pa.compute.max(pa.compute.list_value_length(batch.column("vector"))).as_py() or 0)
            values = _matrix(batch, dims, scale)
            if not len(values):
                continue
            # a dimension that a vector lacks is zero in it
            pad = np.zeros(dims - len(low))
            ends = [np.concatenate([low, pad]), np.concatenate([high, pad])]
            low, high = np.minimum(values.min(0), ends[0]), np.maximum(values.max(0), ends[1])
            n += len(values)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low) + 1)), pa.array([n, *low], pa.float64()), pa.array([n, *high], pa.float64())], ["place", "low", "high"])

    found = rows.select("vector").mapInArrow(extent, "place bigint, low double, high double")
    # a row per dimension reaches the driver, and the number of rows under place 0
    ends = {r.place: r for r in found.groupBy("place").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("low").alias("n")).collect()}
    count = int(ends[0].n) if 0 in ends else 0
    dims = max(ends, default=0) or 1
    low, high = (np.array([getattr(ends[d], end) if d in ends else 0.0 for d in range(1, dims + 1)]) for end in ("low", "high"))
    if dims * max(-low.min(), high.max()) ** 2 >= 2**53:
        raise ValueError("components are too large for exact scores")
    span = np.maximum(high - low, 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch, dims, scale)
            if len(values):
                cells = np.clip((values - low) * (1 << BITS) // (span + 1), 0, (1 << BITS) - 1)
                curve = [k.tobytes() for k in hilbert(cells)]
                vectors = [v.tobytes() for v in values.astype("<i4")]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("anchor"), pa.array(vectors, pa.binary()), pa.array(curve, pa.binary())], ["id", "label", "anchor", "vector", "curve"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, number, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            held += zip(*(batch.column(n).to_pylist() for n in ("id", "label", "anchor", "vector")))
            while len(held) >= block_rows:
                yield block(segment, number, held[:block_rows])
                held, number = held[block_rows:], number + 1
        if held:
            yield block(segment, number, held)

    def block(segment: int, number: int, held: list[tuple]) -> pa.RecordBatch:
        ids, labels, anchors, vectors = zip(*held)
        values, named = np.frombuffer(b"".join(vectors), "<i4").reshape(-1, dims), np.array(labels, np.int64)
        parts = [np.array(ids, np.int64), named, values, np.array(anchors, bool), values.min(0), values.max(0)]
        data = [[segment], [number], *([p.tobytes()] for p in parts), [int(named.min())], [int(named.max())]]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6, pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(d, k) for d, k in zip(data, kinds)], [f.split()[0] for f in BLOCKS.split(", ")])

    placed = rows.mapInArrow(place, "id bigint, label bigint, anchor boolean, vector binary, curve binary")
    dealt = placed.repartitionByRange(max(-(-count // segment_rows), 1), "curve", "id").sortWithinPartitions("curve", "id", "label")
    dealt.mapInArrow(pack, BLOCKS).write.parquet(path)
    return Index(spark, path, dims)


GROUP = "grp bigint, segment int, ids binary, labels binary, vectors binary, low binary, high binary"


def groups_of(index: Index, size: int = ANCHORS) -> DataFrame:
    """The anchors, in groups of neighbours of one segment, each with one window that holds all scores."""

    def group(segment: int, number: int, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, labels, vectors = (np.concatenate(p) for p in zip(*parts))
        ends = np.full((len(ids), 1), np.inf)
        data = [(segment << 32) + number, segment, *(p.tobytes() for p in (ids, labels, vectors, -ends, ends))]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([d], k) for d, k in zip(data, kinds)], [f.split()[0] for f in GROUP.split(", ")])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a group is numbered by the block and row of its first anchor
        of, held, number = None, [], 0
        for batch in batches:
            for segment, block, ids, labels, vectors, marks in zip(*(batch.column(n).to_pylist() for n in ("segment", "block", "ids", "labels", "vectors", "anchors"))):
                if held and segment != of:
                    yield group(of, number, held)
                    held = []
                of, mark = segment, np.frombuffer(marks, bool)
                columns = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), np.frombuffer(vectors, "<i4").reshape(len(mark), -1)
                for at in np.flatnonzero(mark):
                    if not held:
                        number = (block << 16) + int(at)
                    held.append(tuple(c[at : at + 1] for c in columns))
                    if len(held) == size:
                        yield group(of, number, held)
                        held = []
        if held:
            yield group(of, number, held)

    return index.blocks.select("segment", "block", "ids", "labels", "vectors", "anchors").mapInArrow(step, GROUP)


def _anchors(row: dict, dims: int) -> tuple[np.ndarray, ...]:
    """A group's ids, labels, vectors and ends of windows."""
    ids = np.frombuffer(row["ids"], np.int64)
    low, high = (np.frombuffer(row[n], np.float64).reshape(len(ids), -1) for n in ("low", "high"))
    return ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["vectors"], "<i4").reshape(-1, dims).astype(np.float64), low, high


FOUND = "grp bigint, place int, window int, anchor_id bigint, other bigint, score bigint"


def _scan(index: Index, blocks: DataFrame, asked: DataFrame, k: int, same: bool) -> DataFrame:
    """The best ``k`` rows of each window among the blocks that a group asks for in a segment (``chosen``, null for all), with the same label or another.

    A segment's blocks come before the groups that ask for them. The groups of a segment are dealt to copies of it.
    """
    dims = index.dims
    copies = -(-max(asked.select("grp").distinct().count(), 1) // GROUPS)
    empty = F.lit(None).cast("binary")
    data = blocks.select(
        "segment", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(0).alias("kind"), F.col("block").cast("bigint").alias("grp"),
        "ids", "labels", "vectors", empty.alias("low"), empty.alias("high"), F.lit(None).cast("array<int>").alias("chosen"),
    )
    copy = F.pmod(F.xxhash64("grp"), F.lit(copies)).cast("int").alias("copy")
    rows = data.unionByName(asked.select("segment", copy, F.lit(1).alias("kind"), "grp", "ids", "labels", "vectors", "low", "high", "chosen"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, table = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["segment"], row["copy"]) != of:
                    of, held, table = (row["segment"], row["copy"]), [], None
                if row["kind"] == 0:
                    held.append(row)
                    continue
                if not held:
                    continue
                table = table or joined(held)
                yield from best(row, *table)

    def joined(held: list[dict]) -> tuple[np.ndarray, ...]:
        ids, labels, vectors = (b"".join(r[n] for r in held) for n in ("ids", "labels", "vectors"))
        ids, labels, vectors = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), np.frombuffer(vectors, "<i4").reshape(-1, dims)
        block = np.repeat([r["grp"] for r in held], [len(r["ids"]) // 8 for r in held])
        # of equal scores the smaller id comes first
        order = np.argsort(ids, kind="stable")
        return ids[order], labels[order], vectors[order].astype(np.float64), block[order]

    def best(row: dict, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
        if row["chosen"] is not None:
            read = np.isin(block, row["chosen"])
            ids, labels, vectors = ids[read], labels[read], vectors[read]
        own, named, anchors, low, high = _anchors(row, dims)
        worst = -(anchors @ vectors.T)
        away = (named[:, None] != labels[None, :]) if same else (named[:, None] == labels[None, :])
        worst[away | (own[:, None] == ids[None, :])] = np.inf
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        for a, scores in enumerate(worst):
            order = np.argsort(scores, kind="stable")
            scores = scores[order]
            for w, (at, to) in enumerate(zip(np.searchsorted(scores, -high[a]), np.searchsorted(scores, np.minimum(-low[a], 1e300), "right"))):
                to = min(to, at + k)
                if at < to:
                    for column, part in zip(out, (np.full(to - at, a), np.full(to - at, w), np.full(to - at, own[a]), ids[order[at:to]], -scores[at:to])):
                        column.append(part)
        if out[0]:
            place, window, anchor, other, score = map(np.concatenate, out)
            columns = [np.full(len(place), row["grp"]), place.astype(np.int32), window.astype(np.int32), anchor, other, score.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in FOUND.split(", ")])

    return rows.repartition("segment", "copy").sortWithinPartitions("segment", "copy", "kind", "grp").mapInArrow(step, FOUND)


def _attach(groups: DataFrame, rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """Groups with the rows of their anchors, a bounded number for each group."""
    return groups.join(rows.groupBy("grp").agg(F.collect_list(F.struct(*columns)).alias(name)), "grp", "left")


def _choose(index: Index, groups: DataFrame, same: bool) -> DataFrame:
    """Which blocks of other segments each group must read: those whose bounds reach into a window of an anchor, by one row per group and segment.

    ``floors`` are lower ends that a window has meanwhile.
    """
    dims = index.dims
    segments = index.zones.agg(F.max("segment")).first()[0]
    zone = F.struct("block", "low", "high", "label_low", "label_high")
    zones = index.zones.groupBy("segment").agg(F.sort_array(F.collect_list(zone)).alias("zones"))
    other = F.explode(F.filter(F.sequence(F.lit(0), F.lit(segments or 0)), lambda s: s != F.col("home")))
    pairs = groups.withColumnRenamed("segment", "home").withColumn("segment", other).join(zones, "segment")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, named, anchors, low, high = _anchors(row, dims)
                low = low.copy()
                for f in row["floors"] or []:
                    low[f["place"], f["window"]] = max(low[f["place"], f["window"]], f["floor"])
                box_low, box_high = (np.frombuffer(b"".join(z[n] for z in row["zones"]), "<i4").reshape(-1, dims).astype(np.float64) for n in ("low", "high"))
                label_low, label_high = (np.array([z[n] for z in row["zones"]])[None, :] for n in ("label_low", "label_high"))
                least, most = score_bounds(anchors, box_low, box_high)
                if same:
                    fits = (label_low <= named[:, None]) & (named[:, None] <= label_high)
                else:
                    fits = (label_low != named[:, None]) | (label_high != named[:, None])
                reach = ((least[:, :, None] <= high[:, None, :]) & (most[:, :, None] >= low[:, None, :])).any(2) & fits
                if len(chosen := np.flatnonzero(reach.any(0))):
                    numbers = [[row["zones"][i]["block"] for i in chosen]]
                    yield pa.RecordBatch.from_arrays([pa.array([row["grp"]], pa.int64()), pa.array([row["segment"]], pa.int32()), pa.array(numbers, pa.list_(pa.int32()))], ["grp", "segment", "chosen"])

    return pairs.select("grp", "segment", "ids", "labels", "vectors", "low", "high", "floors", "zones").mapInArrow(step, "grp bigint, segment int, chosen array<int>")


def search(index: Index, groups: DataFrame, k: int, same: bool) -> DataFrame:
    """The best ``k`` rows in each window of each anchor, all of them if fewer: rows of the anchor's label if ``same``, else of other labels.

    Ranks are from 1, by falling score and then rising id. The anchor's own id is left out.
    """
    home = checkpoint(_scan(index, index.blocks, groups.withColumn("chosen", F.lit(None).cast("array<int>")), k, same))
    floors = home.groupBy("grp", "place", "window").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    chosen = checkpoint(_choose(index, _attach(groups, floors, "floors", "place", "window", "floor"), same))
    read = chosen.select("segment", F.explode("chosen").alias("block")).distinct()
    asked = chosen.join(groups.drop("segment"), "grp")
    rest = _scan(index, index.blocks.join(read, ["segment", "block"], "left_semi"), asked, k, same)
    rank = F.row_number().over(Window.partitionBy("grp", "place", "window").orderBy(F.desc("score"), "other"))
    return home.unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= k)


def score_windows(groups: DataFrame, positives: DataFrame, count: int, least: int = LEAST_PERCENT, most: int = MOST_PERCENT) -> DataFrame:
    """Groups with a window per positive: the scores between two percentages of its own. A positive with a negative score has an empty one."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for ids, of in zip(batch.column("ids").to_pylist(), batch.column("positives").to_pylist()):
                ends = np.full((2, len(ids) // 8, count), [[[1.0]], [[0.0]]])
                for p in of or []:
                    ends[:, p["place"], p["rank"] - 1] = -(-least * p["score"] // 100), most * p["score"] // 100
                low.append(ends[0].tobytes())
                high.append(ends[1].tobytes())
            columns = [*(batch.column(n) for n in ("grp", "segment", "ids", "labels", "vectors")), pa.array(low, pa.binary()), pa.array(high, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in GROUP.split(", ")])

    with_positives = _attach(groups, positives, "positives", "place", "rank", "score")
    return with_positives.select("grp", "segment", "ids", "labels", "vectors", "positives").mapInArrow(step, GROUP)


def hard_negatives(vectors: DataFrame, anchor: str, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, **sizes: int) -> DataFrame:
    """For each anchor and each of its best rows of its label, the best rows of other labels whose scores lie in that positive's window.

    A score is the inner product of vectors whose components were multiplied by ``SCALE`` and rounded down; ``anchor`` is a condition
    in SQL. Rows with a null label, a null vector, or a component that is null or not finite take no part. A null id takes part,
    after all others among equal scores, and comes out null. Rows of one id are rows of their own, and not each other's partners.
    Vectors shorter than others are filled with zeros. An empty table gives no rows. Columns other than the three named are not read. ``sizes`` go to ``build``.
    """
    spark = vectors.sparkSession
    finite = F.forall(col(vector), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = vectors.where(col(label).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.coalesce(col(vec_id).cast("bigint"), F.lit(NO_ID)).alias("id"),
        col(label).cast("bigint").alias("label"),
        F.coalesce(F.expr(anchor), F.lit(False)).alias("anchor"),
        col(vector).cast("array<double>").alias("vector"),
    )
    index = build(rows, scratch_path(spark, "vectors"), **sizes)
    groups = checkpoint(groups_of(index))
    near = checkpoint(search(index, groups, positives, same=True))
    found = search(index, score_windows(groups, near, positives), negatives, same=False)
    of = near.select("grp", "place", (F.col("rank") - 1).alias("window"), F.col("other").alias("positive"), F.col("score").alias("positive_score"))
    return found.join(of, ["grp", "place", "window"]).select(
        "anchor_id",
        F.nullif(F.col("positive"), F.lit(NO_ID)).alias("positive_id"),
        "rank",
        F.nullif(F.col("other"), F.lit(NO_ID)).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


ORACLE = f"""
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor({SCALE} * x::double)) as q
    from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
    select a.vec_id as anchor_id, c.vec_id as other, a.label = c.label as same, cast(list_inner_product(a.q, c.q) as bigint) as score
    from v a join v c on c.vec_id is distinct from a.vec_id where a.vec_id % 50 = 0),
p as (
    select anchor_id, other as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, other) <= {POSITIVES}),
n as (
    select anchor_id, positive_id, other as negative_id, positive_score, score as negative_score,
           row_number() over (partition by anchor_id, positive_id order by score desc, other) as rank
    from p join s using (anchor_id)
    where not same and {LEAST_PERCENT} * positive_score <= 100 * score and 100 * score <= {MOST_PERCENT} * positive_score)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= {NEGATIVES}
"""


@query(ORACLE)
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, among all vectors, after every seventh got another label."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", changed), "vec_id % 50 = 0")
