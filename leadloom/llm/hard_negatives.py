"""Hard negatives by exact inner product behind a pivot table.

With a bound M on the length of all vectors, a row x becomes (x, sqrt(M^2 - |x|^2)) and an anchor q becomes (q, 0): then
|q' - x'|^2 = M^2 + |q|^2 - 2 q.x, so large products are small distances. Each row's distances to a few pivots are stored. The triangle inequality
over them brackets a pair's distance and so its score: a pair whose best score is too low, or whose worst is too high, is never
multiplied out; the others are checked exactly.

Rows are dealt to groups of bounded size, each a task's own; the anchors stream past them. A group gives at most a few rows for each
anchor (and positive), and the best of these are taken over all groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: A negative's score in hundredths of the positive's, from and to.
FROM, TO = 80, 100
PIVOTS = 8
#: Rows among which the pivots are chosen; the pivots steer the work and never the result.
PIVOT_SAMPLE = 512
#: Components of a group's vectors, 32 MB in its task; a longer vector is a group of its own.
GROUP_CELLS = 1 << 22
LEAST_GROUP = 256
_ANCHORS, _ROWS = 256, 1024
_LONG = (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int) -> DataFrame:
    """row_no, id, label, anchor, vector (floor(scale * x) as doubles) and norm (its square) of the rows that take part."""
    finite = F.forall(F.col(f"`{vector_col}`"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{vector_col}`").isNotNull() & finite)
    rows = rows.select(F.monotonically_increasing_id().alias("row_no"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("bigint").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))

    def floor(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            made = [np.floor(scale * np.array(x.as_py(), np.float64)) for x in batch.column(4)]
            last = [pa.array([x.tobytes() for x in made], pa.binary()), pa.array([float(x @ x) for x in made], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *last], names=["row_no", "id", "label", "anchor", "vector", "norm"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(floor, f"row_no bigint, id {kind}, label bigint, anchor boolean, vector binary, norm double")


def _matrix(cells: list[bytes], size: int):
    """Vectors as rows of a matrix; shorter ones are filled up with zeros."""
    import numpy as np

    out = np.zeros((len(cells), size))
    for k, x in enumerate(cells):
        out[k, : len(x) // 8] = np.frombuffer(x)
    return out


def chosen_pivots(sample, top: float, count: int = PIVOTS):
    """Rows of the matrix ``sample`` and their last component, each as far as can be from those before it."""
    import numpy as np

    extra = np.sqrt(np.maximum(top - (sample**2).sum(1), 0))
    full = np.column_stack([sample, extra])
    at, least = [0] if len(full) else [], np.full(len(full), np.inf)
    while len(at) < min(count, len(full)):
        least = np.minimum(least, ((full - full[at[-1]]) ** 2).sum(1))
        at.append(int(least.argmax()))
    return full[at]


def distances(matrix, last, pivots):
    """Euclidean distances of the rows of ``matrix`` with the further component ``last`` to the pivots."""
    import numpy as np

    return np.column_stack([np.sqrt(((matrix - p[:-1]) ** 2).sum(1) + (last - p[-1]) ** 2) for p in pivots])


def pivot_table(rows: DataFrame, size: int, top: float, pivots) -> DataFrame:
    """``rows`` with their distances to the pivots, as a row and as an anchor."""

    def measure(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            matrix, norm = _matrix(batch.column(4).to_pylist(), size), np.array(batch.column(5))
            as_row = distances(matrix, np.sqrt(np.maximum(top - norm, 0)), pivots)
            as_anchor = distances(matrix, np.zeros(len(norm)), pivots)
            made = [pa.array([x.tobytes() for x in d], pa.binary()) for d in (as_row, as_anchor)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "as_row", "as_anchor"])

    return rows.mapInArrow(measure, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", as_row binary, as_anchor binary")


class Group:
    """The rows of a group in blocks of neighbours, with what the pivots say of them."""

    def __init__(self, rows: list, size: int, top: float):
        import numpy as np

        self.no, self.ids, label, vectors, dist = zip(*rows)
        self.top, self.no, self.label = top, np.array(self.no), np.array(label)
        self.vectors, self.dist = _matrix(vectors, size), np.stack([np.frombuffer(d) for d in dist])
        order = np.lexsort((self.dist.min(1), self.dist.argmin(1)))
        self.blocks = [order[k : k + _ROWS] for k in range(0, len(order), _ROWS)]
        self.reach = np.abs(self.vectors).max(initial=0)

    def brackets(self, dist, norm):
        """For each block: its rows, and functions of the highest and lowest scores of anchors with it by the triangle inequality."""
        import numpy as np

        slack = 1e-9 * (self.top + norm + 1)
        score = lambda d: (self.top + norm[:, None] - d**2) / 2
        for rows in self.blocks:
            of = self.dist[rows]
            apart = np.maximum(np.maximum(dist - of.max(0), of.min(0) - dist), 0).max(1)
            best = (self.top + norm - apart**2) / 2 + slack  # of the whole block
            near = lambda of=of: score(np.max([np.abs(dist[:, [p]] - of[:, p]) for p in range(of.shape[1])], 0)) + slack[:, None]
            far = lambda of=of: score(np.min([dist[:, [p]] + of[:, p] for p in range(of.shape[1])], 0)) - slack[:, None]
            yield rows, best, near, far

    def scores(self, anchors, rows):
        """Exact inner products: in doubles where none can lose a bit, else in Python's integers."""
        import numpy as np

        of = self.vectors[rows]
        if self.reach * np.abs(anchors).max(initial=0) * max(1, of.shape[1]) < 1 << 53:
            return (anchors @ of.T).astype(np.int64)
        whole = np.frompyfunc(int, 1, 1)
        return whole(anchors) @ whole(of).T


def _best(scores, ids, numbers, count: int) -> list[tuple]:
    """The first ``count`` of rows by score downwards, id (none last) and number, as tuples."""
    import numpy as np

    if len(scores) > count:
        least = np.partition(scores, -count)[-count]
        at = np.flatnonzero(scores >= least)
    else:
        at = range(len(scores))
    return sorted((-int(scores[k]), ids[k] is None, ids[k] if ids[k] is not None else 0, int(numbers[k])) for k in at)[:count]


def _merged(old: list[tuple], new: list[tuple], count: int) -> list[tuple]:
    return sorted(old + new)[:count]


def positives_of(group: Group, anchors: list, size: int, count: int) -> list[list[tuple]]:
    """For each anchor (number, label, vector, distances, norm) its first ``count`` other rows of its label in the group."""
    import numpy as np

    no, label, vectors, dist, norm = (list(x) for x in zip(*anchors))
    no, label, norm, q = np.array(no), np.array(label), np.array(norm), _matrix(vectors, size)
    best, floor = [[] for _ in no], np.full(len(no), -np.inf)
    for rows, top, near, far in group.brackets(np.stack([np.frombuffer(d) for d in dist]), norm):
        if (top < floor).all():
            continue
        same = (label[:, None] == group.label[rows]) & (no[:, None] != group.no[rows])
        if len(rows) > count:  # as many as are wanted score no less than the lower brackets say
            low = np.where(same, far(), -np.inf)
            floor = np.maximum(floor, np.partition(low, -count, axis=1)[:, -count])
        keep = same & (near() >= floor[:, None])
        a, r = np.flatnonzero(keep.any(1)), np.flatnonzero(keep.any(0))
        if not len(a):
            continue
        exact = group.scores(q[a], rows[r])
        for k, i in enumerate(a.tolist()):
            at = np.flatnonzero(keep[i, r])
            own = rows[r[at]]
            best[i] = _merged(best[i], _best(exact[k, at], [group.ids[x] for x in own], group.no[own], count), count)
            if len(best[i]) == count:
                floor[i] = max(floor[i], -best[i][-1][0] - 1e-9 * abs(best[i][-1][0]))
    return best


def negatives_of(group: Group, anchors: list, positives: list[list[int]], size: int, count: int, lowest: int, highest: int) -> list[list[list[tuple]]]:
    """For each anchor and each score of its positives the first ``count`` rows of other labels whose score is in the window of it."""
    import numpy as np

    no, label, vectors, dist, norm = (list(x) for x in zip(*anchors))
    label, norm, q = np.array(label), np.array(norm), _matrix(vectors, size)
    best = [[[] for _ in p] for p in positives]
    low = np.array([float(min(lowest * s for s in p)) / 100 for p in positives])
    high = np.array([float(max(highest * s for s in p)) / 100 for p in positives])
    slack = 1e-9 * (np.abs(low) + np.abs(high))
    low, high = low - slack, high + slack
    for rows, top, near, far in group.brackets(np.stack([np.frombuffer(d) for d in dist]), norm):
        if (top < low).all():
            continue
        keep = (label[:, None] != group.label[rows]) & (near() >= low[:, None]) & (far() <= high[:, None])
        a, r = np.flatnonzero(keep.any(1)), np.flatnonzero(keep.any(0))
        if not len(a):
            continue
        exact = group.scores(q[a], rows[r])
        for k, i in enumerate(a.tolist()):
            at = np.flatnonzero(keep[i, r] & (exact[k] >= low[i]) & (exact[k] <= high[i]))
            own, scores = rows[r[at]], exact[k, at]
            for j, s in enumerate(positives[i]):
                fits = np.flatnonzero((100 * scores >= lowest * s) & (100 * scores <= highest * s))
                if len(fits):
                    best[i][j] = _merged(best[i][j], _best(scores[fits], [group.ids[x] for x in own[fits]], group.no[own[fits]], count), count)
    return best


def _clip(score: int) -> int:
    return max(-_LONG - 1, min(_LONG, score))


def _past(rows: DataFrame, anchors: DataFrame, groups: int, size: int, top: float, found, schema: str) -> DataFrame:
    """``found(group, anchors)`` over all groups: in each, its rows come first, then all anchors in batches."""
    # Only anchors carry ``wanted``, the scores of their positives.
    columns = ["row_no", "id", "label", "vector", "norm", "dist", "wanted"]
    own = rows.select(F.pmod(F.xxhash64("row_no"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("kind"), *columns)
    seen = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("kind"), *columns)
    together = own.unionByName(seen).repartitionById(groups, "group").sortWithinPartitions("group", "kind")

    def pass_by(batches):
        group, held, built, waiting = None, [], None, []
        for batch in batches:
            for g, kind, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if g != group:
                    if waiting:
                        yield found(built, waiting)
                    group, held, built, waiting = g, [], None, []
                if not kind:
                    held.append((row[0], row[1], row[2], row[3], row[5]))
                elif held:
                    built = built or Group(held, size, top)
                    waiting.append(row)
                    if len(waiting) == _ANCHORS:
                        yield found(built, waiting)
                        waiting = []
        if waiting:
            yield found(built, waiting)

    return together.mapInArrow(pass_by, schema)


def hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = FROM, highest: int = TO, group_cells: int = GROUP_CELLS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: hard negatives of the rows for which ``anchor`` holds.

    Scores are exact inner products of floor(scale * x); higher ones come first, of equal ones the smaller id, a null id last. An anchor's positives are
    its first ``positives`` other rows of its label; for each, the first ``negatives`` rows of other labels from ``lowest`` to
    ``highest`` hundredths of its score follow. Rows with a null label or vector, or a null or non-finite component, take no part; a
    shorter vector counts as filled up with zeros; a repeated row is a row like any other; a null ``anchor`` is false; scores beyond
    a long are given as the nearest long; no rows or no anchors give none. Labels are integers; other columns are not read.
    """
    import numpy as np

    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    rows = materialize(quantised(vectors, id_col, vector_col, label_col, anchor, scale), "vectors")
    n, top, size = rows.agg(F.count(F.lit(1)), F.max("norm"), F.max(F.length("vector"))).first()
    top, size = float(top or 0), (size or 0) // 8
    sample = rows.orderBy(F.xxhash64("row_no"), "row_no").limit(PIVOT_SAMPLE).select("vector").collect()  # PIVOT_SAMPLE rows at most
    pivots = chosen_pivots(_matrix([r.vector for r in sample] or [np.zeros(size).tobytes()], size), top)
    stored = materialize(pivot_table(rows, size, top, pivots), "pivot-table")
    groups = max(-(-n * size // group_cells), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST_GROUP)), 1)
    wanted = F.lit(None).cast("array<struct<no:bigint,score:bigint>>").alias("wanted")
    own = stored.withColumn("dist", F.col("as_row")).withColumn("wanted", wanted)
    anchors = stored.where("anchor").withColumn("dist", F.col("as_anchor"))

    def batch(names, columns, kinds):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def find_positives(group, waiting):
        import pyarrow as pa

        best = positives_of(group, [(a[0], a[2], a[3], a[5], a[4]) for a in waiting], size, positives)
        out = [(a[0], no, _clip(-s)) for a, found in zip(waiting, best) for s, _, _, no in found]
        return batch(["anchor_no", "no", "score"], list(zip(*out)) or [[]] * 3, [pa.int64()] * 3)

    def find_negatives(group, waiting):
        import pyarrow as pa

        scores = [[w["score"] for w in a[6]] for a in waiting]
        best = negatives_of(group, [(a[0], a[2], a[3], a[5], a[4]) for a in waiting], scores, size, negatives, lowest, highest)
        out = [(a[0], w["no"], w["score"], no, _clip(-s)) for a, found in zip(waiting, best) for w, rest in zip(a[6], found) for s, _, _, no in rest]
        return batch(["anchor_no", "no", "score", "negative_no", "negative_score"], list(zip(*out)) or [[]] * 5, [pa.int64()] * 5)

    named = stored.select("row_no", "id")
    first = _past(own, anchors.withColumn("wanted", wanted), groups, size, top, find_positives, "anchor_no bigint, no bigint, score bigint")
    first = first.join(named.select(F.col("row_no").alias("no"), F.col("id").alias("positive_id")), "no")
    by = Window.partitionBy("anchor_no").orderBy(F.desc("score"), F.asc_nulls_last("positive_id"), "no")
    first = materialize(first.withColumn("place", F.row_number().over(by)).where(F.col("place") <= positives).drop("place"), "positives")
    of_anchor = first.groupBy(F.col("anchor_no").alias("row_no")).agg(F.collect_list(F.struct("no", "score")).alias("wanted"))  # ``positives`` at most
    second = _past(own, anchors.join(of_anchor, "row_no"), groups, size, top, find_negatives, "anchor_no bigint, no bigint, score bigint, negative_no bigint, negative_score bigint")
    second = second.join(named.select(F.col("row_no").alias("negative_no"), F.col("id").alias("negative_id")), "negative_no")
    by = Window.partitionBy("anchor_no", "no").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_no")
    second = second.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives)
    second = second.join(first.select("anchor_no", "no", "positive_id"), ["anchor_no", "no"])
    second = second.join(named.select(F.col("row_no").alias("anchor_no"), F.col("id").alias("anchor_id")), "anchor_no")
    return second.select(F.col("anchor_id").cast(kind), "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of all embeddings whose vec_id 100 divides; where 7 divides vec_id, the label is the next of ten."""
    given = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(given.withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) QUALIFY rank <= 5
"""
