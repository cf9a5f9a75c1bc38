"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.components import connected_components
from stationcast.llm.store import stored

#: Vectors the rotation is learnt from, those with the smallest hash of their components.
FIT_VECTORS = 20_000
#: Table keys of a query differ from the stored ones in at most so many bits.
RADIUS = 1
#: Of the pairs at the threshold, the share that the tables should find.
RECALL = 0.99
#: The bits that candidates are compared by, in words of 64.
CODE_BITS = 256
PAIRS_AT_ONCE = 20_000


class Codes(NamedTuple):
    """How vectors of one dimension become codes: they are centred, and a bit is the side of a plane on
    which a vector lies. The first bits are the code; each table's key is ``width`` further on."""

    mean: np.ndarray
    directions: np.ndarray
    tables: int
    width: int


def learn_rotation(sample: np.ndarray, bits: int, rounds: int = 50, seed: int = 7) -> np.ndarray:
    """Directions whose signs are the code of centred vectors: principal axes, turned so that signs lose
    little.

    The turn alternates between the nearest signs and the nearest orthogonal matrix (Procrustes).
    With more bits than axes, the further ones are the same space in random turns.
    """
    rng = np.random.default_rng(seed)
    dimension = sample.shape[1]
    if not len(sample):
        return rng.normal(size=(dimension, bits))
    values, axes = np.linalg.eigh(sample.T @ sample / len(sample))
    # As many axes as bits; none is left out for little variance, near copies may differ there.
    axes = axes[:, np.argsort(-values, kind="stable")][:, :bits]
    projected = sample @ axes
    turn, _ = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))
    for _ in range(rounds):
        signs = np.where(projected @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(signs.T @ projected)
        turn = (u @ v).T
    parts = [axes @ turn]
    while sum(part.shape[1] for part in parts) < bits:
        parts.append(np.linalg.qr(rng.normal(size=(dimension, dimension)))[0])
    return np.hstack(parts)[:, :bits]


def angle_share(threshold: float, norm_a, norm_b):
    """The angle, as a share of pi, that two unit vectors at the threshold have once they are centred and
    have these lengths: their distance stays the same."""
    cosine = (norm_a ** 2 + norm_b ** 2 - 2 * (1 - threshold)) / np.maximum(2 * norm_a * norm_b, 1e-12)
    return np.arccos(np.clip(cosine, -1, 1)) / np.pi


def plan_tables(rows: int, share: float, recall: float = RECALL) -> tuple[int, int]:
    """Number of tables and key width: enough tables for the recall, of the width with the least work.

    A pair at the threshold differs in a ``share`` of its bits and is found in a table if its keys differ
    in ``RADIUS`` bits at most. A query looks up 1 + width keys per table (at radius 1) and meets
    rows / 2 ** width strangers under each, so keys grow with the logarithm of the rows.
    """
    share = min(max(share, 0.01), 0.45)
    best = None
    for width in range(6, 31):
        found = sum(math.comb(width, k) * share ** k * (1 - share) ** (width - k)
                    for k in range(RADIUS + 1))
        tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))
        looked_up = sum(math.comb(width, k) for k in range(RADIUS + 1))
        work = tables * looked_up * (1 + rows / 2 ** width)
        if best is None or work < best[0]:
            best = work, tables, width
    return best[1:]


def learn_codes(sample: np.ndarray, rows: int, threshold: float) -> Codes:
    """Centre, directions and tables for the vectors of one dimension, from a sample of unit vectors."""
    mean = sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])
    centred = sample - mean
    # What a common direction hides shows in the centred lengths: most pairs are longer than this.
    low = float(np.quantile(np.linalg.norm(centred, axis=1), 0.1)) if len(sample) else 1.0
    tables, width = plan_tables(rows, float(angle_share(threshold, low, low)))
    return Codes(mean, learn_rotation(centred, max(CODE_BITS, tables * width)), tables, width)


def unit_vectors(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1, and which rows have one: not null, finite, not zero, right dimension."""
    out, good = np.zeros((len(column), dimension)), np.zeros(len(column), bool)
    size = column.value_lengths().fill_null(-1).to_numpy()
    whole = np.flatnonzero(size == dimension)
    if len(whole) and dimension:
        taken = column.take(pa.array(whole)).flatten().cast(pa.float64())
        flat = taken.to_numpy(zero_copy_only=False).reshape(-1, dimension)   # null reads as NaN
        finite = np.isfinite(flat).all(axis=1)
        flat = np.where(finite[:, None], flat, 0.0)
        # Scaled by the largest component first: squares neither overflow nor vanish.
        most = np.abs(flat).max(axis=1)
        some = finite & (most > 0)
        scaled = flat[some] / most[some][:, None]
        good[whole[some]] = True
        out[whole[some]] = scaled / np.linalg.norm(scaled, axis=1)[:, None]
    return out, good


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of at most 64 bits as integers."""
    weights = np.uint64(1) << np.arange(bits.shape[-1], dtype=np.uint64)
    return np.where(bits, weights, np.uint64(0)).sum(axis=-1, dtype=np.uint64).view(np.int64)


def encode(vectors: DataFrame, codes: dict[int, Codes]) -> DataFrame:
    """Codes of the usable rows: (rep, copies, size, code, keys, norm, unit), ``norm`` the length of the
    centred unit vector.

    Each vector is coded by the planes of its own size; those of other sizes are left out.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            size = batch.column("embedding").value_lengths().to_numpy()
            for n in np.unique(size).tolist():
                if n not in shared.value:
                    continue
                plan = shared.value[n]
                part = batch.take(pa.array(np.flatnonzero(size == n)))
                unit, good = unit_vectors(part.column("embedding"), n)
                keep = np.flatnonzero(good)
                centred = unit[keep] - plan.mean
                bits = centred @ plan.directions >= 0
                keys = _packed(bits[:, :plan.tables * plan.width].reshape(
                    len(keep), plan.tables, plan.width))
                rows = part.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([
                    rows.column("rep"), rows.column("copies"),
                    pa.array(np.full(len(keep), n, np.int32)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(keep) + 1, dtype=np.int32) * (CODE_BITS // 64)),
                        pa.array(_packed(bits[:, :CODE_BITS].reshape(len(keep), -1, 64)).ravel())),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(keep) + 1, dtype=np.int32) * plan.tables),
                        pa.array(keys.ravel())),
                    pa.array(np.linalg.norm(centred, axis=1)),
                    pa.array([u.tobytes() for u in unit[keep]], pa.binary()),
                ], ["rep", "copies", "size", "code", "keys", "norm", "unit"])

    return vectors.select("rep", "copies", "embedding").mapInArrow(
        run, "rep bigint, copies bigint, size int, code array<bigint>, keys array<bigint>, norm double, "
             "unit binary")


def candidate_pairs(codes: DataFrame, widths: dict[int, int], threshold: float) -> DataFrame:
    """Pairs (a < b) of one size that meet in a table, and whose codes differ in no more bits than four
    deviations above what the threshold and their centred lengths allow; each pair once.

    Every vector is held under its key of each table and asks for that key and all within a radius of one
    bit.
    """
    width = F.coalesce(*[F.when(F.col("size") == n, F.lit(w)) for n, w in widths.items()], F.lit(0))
    one_bit = F.transform(F.sequence(F.lit(0), width - 1),
                          lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
    flips = F.concat(F.array(F.lit(0).cast("bigint")), one_bit)
    table = F.posexplode("keys").alias("table", "key")
    words = range(CODE_BITS // 64)
    held, asked = (codes.select("size", *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "norm")], *[
        F.get("code", F.lit(i)).alias(f"code_{side}{i}") for i in words], table) for side in "ba")
    asked = asked.withColumn("flip", F.explode(flips)).withColumn(
        "key", F.col("key").bitwiseXOR(F.col("flip"))).drop("flip")
    a, b = F.col("norm_a"), F.col("norm_b")
    cosine = (a * a + b * b - 2 * (1 - threshold)) / F.greatest(2 * a * b, F.lit(1e-12))
    share = F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0))) / math.pi
    most = CODE_BITS * share + 4 * F.sqrt(CODE_BITS * share * (1 - share))
    apart = sum((F.bit_count(F.col(f"code_a{i}").bitwiseXOR(F.col(f"code_b{i}"))) for i in words),
                F.lit(0))
    return (asked.join(held, ["size", "table", "key"])
            .where((F.col("rep_a") < F.col("rep_b")) & (apart <= F.ceil(most)))
            .select("size", F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct())


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the edges (a, b) connect what the ones before them have left apart."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    keep = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep[k] = True
    return keep


def _sample(classes: DataFrame, dimension: int, fit: int) -> np.ndarray:
    """Unit vectors of one dimension, at most ``fit``, those with the smallest hash."""
    chosen = (classes.where(F.size("embedding") == dimension)
              .orderBy(F.xxhash64("embedding"), "rep").limit(fit).select("embedding"))
    drawn = np.array([r["embedding"] for r in chosen.collect()]).reshape(-1, dimension)
    drawn = drawn / np.abs(drawn).max(axis=1, keepdims=True)
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def near_vectors(vectors: DataFrame, threshold: float = 0.9, fit: int = FIT_VECTORS) -> DataFrame:
    """Link the vectors of ``vectors`` (vec_id, embedding) whose cosine reaches ``threshold``.

    Vectors are compared with those of their own dimension. A centre and a rotation are learnt for each
    dimension, from at most ``fit`` vectors and by a job of its own; all are indexed and all are queries.
    Candidates are compared by their original vectors in double precision, so no link below the
    threshold comes out; the tables may miss some above it. Equal vectors are one class: they are
    linked with each other and share their links, and are never paired.

    Returns one row per input row: vec_id, n_links, component_id, kept. A vector that is null, zero,
    or has null or non-finite components, links with nothing. A null id
    has null component and is not kept; rows with one id and different vectors are linked by
    vector, and share the id's smallest component. An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    usable = rows.where(F.col("vec_id").isNotNull()
                        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                                   & (F.abs(x) < float("inf")))
                        & F.exists("embedding", lambda x: x != 0))
    # Adding zero makes -0.0 and 0.0 one.
    usable = usable.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    classes = stored(usable.groupBy("embedding").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    # A class alone in its dimension has no pairs.
    dimensions = {r["n"]: r["count"] for r in classes.groupBy(F.size("embedding").alias("n")).count()
                  .where("count > 1").orderBy("n").collect()}
    plans = {n: learn_codes(_sample(classes, n, fit), rows, threshold)
             for n, rows in dimensions.items()}
    codes = stored(encode(classes, plans), "codes")
    # One id may stand for several classes: the classes are told apart by number.
    pairs = candidate_pairs(codes.select("rep", "size", "code", "keys", "norm"),
                            {n: plan.width for n, plan in plans.items()}, threshold)
    units = codes.select("rep", "copies", "size", "unit")
    first = units.select("size", F.col("rep").alias("a"), F.col("copies").alias("copies_a"),
                         F.col("unit").alias("unit_a"))
    second = units.select("size", F.col("rep").alias("b"), F.col("copies").alias("copies_b"),
                          F.col("unit").alias("unit_b"))

    def rerank(batches):
        """Of the links in a batch only sums per vector (b null) and the edges that connect (n null)."""
        for batch in batches:
            for k in range(0, batch.num_rows, PAIRS_AT_ONCE):
                some = batch.slice(k, PAIRS_AT_ONCE)
                size = some.column("size").to_numpy()
                for n in np.unique(size).tolist():
                    part = some.take(pa.array(np.flatnonzero(size == n)))
                    x, y = (np.frombuffer(b"".join(part.column(c).to_pylist())).reshape(-1, n)
                            for c in ("unit_a", "unit_b"))
                    part = part.filter(pa.array(np.einsum("ij,ij->i", x, y) >= threshold))
                    a, b, of_a, of_b = (part.column(c).to_numpy()
                                        for c in ("a", "b", "copies_a", "copies_b"))
                    ends, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                    sums = np.bincount(at.reshape(-1), np.concatenate([of_b, of_a]), len(ends))
                    edge = _forest(a, b)
                    rows = len(ends) + int(edge.sum())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(rows, n, np.int32)),
                        pa.array(np.concatenate([ends, a[edge]])),
                        pa.array([None] * len(ends) + b[edge].tolist(), pa.int64()),
                        pa.array(sums.astype(np.int64).tolist() + [None] * int(edge.sum()), pa.int64()),
                    ], ["size", "a", "b", "n"])

    links = stored(pairs.join(first, ["size", "a"]).join(second, ["size", "b"]).select(
        "size", "a", "b", "copies_a", "copies_b", "unit_a", "unit_b").mapInArrow(
        rerank, "size int, a bigint, b bigint, n bigint"), "links")
    near = links.where("n IS NOT NULL").groupBy("size", F.col("a").alias("rep")).agg(
        F.sum("n").alias("near"))
    found = connected_components(links.where("b IS NOT NULL").select("a", "b")).withColumnRenamed(
        "node", "rep")
    per_class = (classes.withColumn("size", F.size("embedding"))
                 .join(near, ["size", "rep"], "left").join(found, "rep", "left").select(
        "embedding", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id")))
    # A component is named by its smallest class, whose name is its smallest id.
    linked = usable.join(per_class, "embedding").select("vec_id", "n_links", "component_id")
    return (rows.select("vec_id").join(
        linked.groupBy("vec_id").agg(F.max("n_links").alias("n_links"),
                                     F.min("component_id").alias("component_id")), "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op7_iterative_quantisation(spark, vectors: DataFrame) -> DataFrame:
    """Links and components of all vectors; odd rows as in ``near_vectors``."""
    return near_vectors(vectors)
