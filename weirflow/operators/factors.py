"""Biased matrix factorisation by stratified stochastic gradient descent.

A rating is predicted as mean + user bias + item bias + product of two factor rows.  Users and items are
dealt into as many blocks each; a stratum pairs every user block with another item block, so its
tasks share no user and no item and may descend at once.  After as many strata as blocks each rating
has been visited once.  All folds run side by side as further tasks of each stratum.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirflow.lineage import cut_lineage, drop_folder, work_folder, written

CELL = 250_000   # ratings one task descends through, by which the number of blocks is chosen
LEAST_BLOCKS = 2
TOGETHER = 8     # ratings from which one step for all is cheaper than a step each
# fixed values: the usual settings of this model
RANK, EPOCHS, RATE, PENALTY, SPREAD = 100, 20, 0.005, 0.02, 0.1
USER, ITEM, RATING = 0, 1, 2
SLAB = 4 << 20   # bytes of factors, or ratings' ids, in one stored row
_FACTORS = "fold int, kind int, id long, block int, bias double, factors array<double>"
#: ids and their numbers as bytes: a row holds a slab of a block, or of a cell's ratings
_SLABS = "fold int, kind int, block int, part int, ids binary, bias binary, factors binary"
_CELLS = "stratum int, fold int, kind int, cell int, part int, ids binary, bias binary, other binary, level binary"


def hashed_fold(user: Column, item: Column, folds: int) -> Column:
    """A fold per (user, item), from the digest of both, so that other engines can name it too."""
    digest = F.md5(F.concat_ws(":", user.cast("string"), item.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % folds).cast("int")


def start_row(seed: int, kind: int, key: int, rank: int = RANK) -> np.ndarray:
    """The factors that a user or item begins with: normal, the same wherever they are drawn."""
    return np.random.default_rng([seed, kind, key & (2**64 - 1)]).normal(0.0, SPREAD, rank)


def descend(
    users: np.ndarray, items: np.ndarray, ratings: np.ndarray, mean: float, biases: tuple[np.ndarray, np.ndarray],
    factors: tuple[np.ndarray, np.ndarray], rate: float, penalty: float,
) -> None:
    """One pass over some ratings, in their order, changing biases and factors in place.

    ``users`` and ``items`` index the rows of the first and second array of each pair.  A rating waits for
    the earlier ones of its user and its item only; ratings that wait for nothing more share neither, so
    they are taken together, with the result of one after the other.
    """
    level = waits(users, items)
    order = np.argsort(level, kind="stable")
    _follow(users[order], items[order], ratings[order], level[order], mean, biases, factors, rate, penalty)


def _follow(
    users: np.ndarray, items: np.ndarray, ratings: np.ndarray, level: np.ndarray, mean: float, biases: tuple[np.ndarray, np.ndarray],
    factors: tuple[np.ndarray, np.ndarray], rate: float, penalty: float,
) -> None:
    """``descend`` for ratings that lie by their level already."""
    user_bias, item_bias = biases
    of_user, of_item = factors
    bounds = [0, *(np.flatnonzero(np.diff(level)) + 1).tolist(), len(level)]
    for low, high in zip(bounds, bounds[1:]):
        at = slice(low, high)
        if high - low >= TOGETHER:
            u, i = users[at], items[at]
            p, q, a, b = of_user[u], of_item[i], user_bias[u], item_bias[i]
            error = ratings[at] - (mean + a + b + np.einsum("ij,ij->i", p, q))
            user_bias[u], item_bias[i] = a + rate * (error - penalty * a), b + rate * (error - penalty * b)
            error = error[:, None]
            of_user[u], of_item[i] = p + rate * (error * q - penalty * p), q + rate * (error * p - penalty * q)
            continue
        for u, i, r in zip(users[at].tolist(), items[at].tolist(), ratings[at].tolist()):
            p, q = of_user[u], of_item[i]
            error = r - (mean + user_bias[u] + item_bias[i] + p @ q)
            user_bias[u] += rate * (error - penalty * user_bias[u])
            item_bias[i] += rate * (error - penalty * item_bias[i])
            step = rate * (error * q - penalty * p)
            q += rate * (error * p - penalty * q)
            p += step


def waits(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """For each rating the length of the longest chain of earlier ones that share a user or an item, link by link."""
    of_user, of_item = [0] * (int(users.max(initial=-1)) + 1), [0] * (int(items.max(initial=-1)) + 1)
    out = []
    for u, i in zip(users.tolist(), items.tolist()):
        a, b = of_user[u], of_item[i]
        longest = a if a > b else b
        out.append(longest)
        of_user[u] = of_item[i] = longest + 1
    return np.array(out, dtype=np.int64)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(blocks)).cast("int")


def blocks_for(ratings: DataFrame, cell: int = CELL) -> int:
    """Blocks of users and of items so that a cell holds about ``cell`` ratings, also those of a hot user or item."""
    total = ratings.count()
    hottest = max([r.n or 0 for c in ("user_id", "product_id") for r in ratings.groupBy(c).count().agg(F.max("count").alias("n")).collect()])
    return max(LEAST_BLOCKS, int(np.ceil(np.sqrt(total / cell))), -(-hottest // cell))


def _slabs(names: Sequence[str], fixed: Sequence, arrays: Sequence[np.ndarray], size: int) -> pa.RecordBatch:
    """Arrays of one length cut into rows of ``size`` elements: the fixed values, the part, the bytes of each array."""
    parts = range(0, len(arrays[0]), size)
    whole = [pa.array([v] * len(parts), pa.int32()) for v in fixed]
    cut = [pa.array([a[at:at + size].tobytes() for at in parts], pa.binary()) for a in arrays]
    return pa.RecordBatch.from_arrays([*whole, pa.array(range(len(parts)), pa.int32()), *cut], names=list(names))


def _joined(rows: pa.Table, column: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(column).to_pylist()), dtype)


def _block_start(seed: int, rank: int):
    """The task of one block: its ids in order with their first factors, drawn once for all folds."""
    size = max(1, SLAB // (8 * rank))

    def run(table: pa.Table) -> pa.Table:
        kind, block = table.column("kind")[0].as_py(), table.column("block")[0].as_py()
        folds, ids = table.column("fold").to_numpy(), table.column("id").to_numpy()
        every = np.unique(ids)
        rows = np.stack([start_row(seed, kind, i, rank) for i in every.tolist()])
        out = []
        for fold in np.unique(folds).tolist():
            own = np.isin(every, ids[folds == fold])
            out.append(_slabs([c.split()[0] for c in _SLABS.split(", ")], [fold, kind, block],
                              [every[own], np.zeros(int(own.sum())), rows[own]], size))
        return pa.Table.from_batches(out)

    return run


def _cell(folds: Sequence[int]):
    """The task of one cell: for each fold the others' ratings in the order of the descent, with their levels, which no epoch changes."""
    size = max(1, SLAB // 8)

    def run(table: pa.Table) -> pa.Table:
        stratum, cell = table.column("stratum")[0].as_py(), table.column("cell")[0].as_py()
        of, *columns = (table.column(c).to_numpy() for c in ("fold", "id", "other", "bias"))
        out = []
        for fold in folds:
            users, items, ratings = (c[of != fold] for c in columns)
            # by item, then by user
            order = np.lexsort((users, items))
            level = waits(*(np.unique(a[order], return_inverse=True)[1] for a in (users, items)))
            later = np.argsort(level, kind="stable")
            order = order[later]
            out.append(_slabs([c.split()[0] for c in _CELLS.split(", ")], [stratum, fold, RATING, cell],
                              [users[order], ratings[order], items[order], level[later]], size))
        return pa.Table.from_batches(out)

    return run


def _stratum(means: dict[int, float], rank: int, rate: float, penalty: float):
    """The task of one fold and user block: its factor rows after the ratings of this stratum."""
    size = max(1, SLAB // (8 * rank))

    def run(table: pa.Table) -> pa.Table:
        fold = table.column("fold")[0].as_py()
        table = table.sort_by("part")
        kind = table.column("kind").to_numpy()
        rows = {k: table.filter(pa.array(kind == k)) for k in (USER, ITEM, RATING)}
        ids = [_joined(rows[k], "ids", "int64") for k in (USER, ITEM)]
        biases = tuple(_joined(rows[k], "bias", "float64").copy() for k in (USER, ITEM))
        factors = tuple(_joined(rows[k], "factors", "float64").reshape(-1, rank).copy() for k in (USER, ITEM))
        # a block's ids lie in order
        users, items = (np.searchsorted(own, _joined(rows[RATING], c, "int64")) for own, c in zip(ids, ("ids", "other")))
        ratings, level = _joined(rows[RATING], "bias", "float64"), _joined(rows[RATING], "level", "int64")
        if len(ratings):
            _follow(users, items, ratings, level, means[fold], biases, factors, rate, penalty)
        return pa.Table.from_batches([
            _slabs([c.split()[0] for c in _SLABS.split(", ")], [fold, k, rows[k].column("block")[0].as_py()], [ids[k], biases[k], factors[k]], size)
            for k in (USER, ITEM) if len(ids[k])])

    return run


def _factor_rows(rank: int):
    """Slabs as a row an id."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "int64")
                same = [pa.array(np.full(len(ids), row[c]), pa.int32()) for c in ("fold", "kind", "block")]
                flat = pa.array(np.frombuffer(row["factors"], "float64"))
                yield pa.RecordBatch.from_arrays(
                    [same[0], same[1], pa.array(ids), same[2], pa.array(np.frombuffer(row["bias"], "float64")),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * rank, pa.int32()), flat)],
                    names=["fold", "kind", "id", "block", "bias", "factors"])

    return run


def fit_folds(
    ratings: DataFrame, folds: int = 3, rank: int = RANK, epochs: int = EPOCHS, rate: float = RATE, penalty: float = PENALTY,
    seed: int = 42, blocks: int | None = None,
) -> tuple[DataFrame, dict[int, float]]:
    """The models fitted without each fold: (fold, kind, id, block, bias, factors), and their mean ratings.

    ``ratings`` holds user_id, product_id (whole numbers), rating and ``fold``, one row a pair.  An epoch
    visits strata 0, 1, ...; a cell's ratings are visited by item and user, so the result is the same on
    every run and for any number of tasks.  What a task holds is a cell's ratings and two blocks of
    factors.  Factors are written after each stratum: a lost executor repeats one stratum.  Between strata
    blocks and ratings lie as bytes, some megabytes a row; ratings in the order of their descent.
    """
    spark = ratings.sparkSession
    folder = work_folder(spark)
    known = ratings.select("user_id", "product_id", F.col("rating").cast("double").alias("rating"), "fold").dropna()
    known = written(known, f"{folder}/known")
    n = blocks or blocks_for(known)
    sums = {r.fold: (r.total, r.many) for r in known.groupBy("fold").agg(F.sum("rating").alias("total"), F.count("*").alias("many")).collect()}
    means = {}
    for fold in range(folds):
        others = [v for k, v in sums.items() if k != fold]
        many = sum(m for _, m in others)
        if many:
            means[fold] = sum(t for t, _ in others) / many
    # the models that each fold's ratings train
    model = F.explode(F.array(*[F.lit(f) for f in sorted(means)] or [F.lit(0)]))
    trained = lambda df: df.withColumnRenamed("fold", "of").withColumn("fold", model).filter("of <> fold").drop("of")
    cell, block = _block(F.col("user_id"), n), _block(F.col("product_id"), n)
    dealt = known.select(
        F.pmod(block - cell, F.lit(n)).alias("stratum"), cell.alias("cell"), F.col("fold").cast("int").alias("fold"),
        F.col("user_id").cast("long").alias("id"), F.col("product_id").cast("long").alias("other"), F.col("rating").alias("bias"))
    # a folder a stratum: each reads its own ratings, not all of them
    cells = dealt.groupBy("stratum", "cell").applyInArrow(_cell(sorted(means)), _CELLS)
    cells.write.partitionBy("stratum").parquet(f"{folder}/trained")
    cells = spark.read.schema(cells.schema).parquet(f"{folder}/trained")

    keyed = lambda kind, key: trained(known.select("fold", F.col(key).cast("long").alias("id")).distinct()).distinct().select(
        "fold", F.lit(kind).alias("kind"), "id", _block(F.col("id"), n).alias("block"))
    begun = keyed(USER, "user_id").unionByName(keyed(ITEM, "product_id")).groupBy("kind", "block").applyInArrow(_block_start(seed, rank), _SLABS)
    state = written(begun, f"{folder}/state-0")
    none = F.lit(None).cast("binary")
    for k in range(epochs * n):
        # user block c meets item block c + k: the cell of a user is its block, of an item the user block it meets
        cell = F.when(F.col("kind") == USER, F.col("block")).otherwise(F.pmod(F.col("block") - F.lit(k % n), F.lit(n)))
        rows = state.withColumns({"cell": cell, "other": none, "level": none})
        now = cells.filter(F.col("stratum") == k % n).drop("stratum").withColumns({"block": F.lit(None).cast("int"), "factors": none})
        task = _stratum(means, rank, rate, penalty)
        state = written(rows.unionByName(now).groupBy("fold", "cell").applyInArrow(task, _SLABS), f"{folder}/state-{k + 1}")
        drop_folder(spark, f"{folder}/state-{k}")
    model = written(state.mapInArrow(_factor_rows(rank), _FACTORS), f"{folder}/model")
    drop_folder(spark, f"{folder}/state-{epochs * n}")
    return model, means


def predict(ratings: DataFrame, model: DataFrame, means: dict[int, float], low: float = 1.0, high: float = 5.0) -> DataFrame:
    """(user_id, product_id, rating, prediction, fold): each rating by the model that has not seen it.

    A user or item that model doesn't know adds nothing; predictions are kept within ``low`` and ``high``.
    """
    side = lambda kind, name, key: model.filter(F.col("kind") == kind).select(
        "fold", F.col("id").alias(key), F.col("bias").alias(f"{name}_bias"), F.col("factors").alias(f"{name}_factors"))
    joined = ratings.select("user_id", "product_id", "rating", "fold").join(
        side(USER, "u", "user_id"), ["fold", "user_id"], "left").join(side(ITEM, "i", "product_id"), ["fold", "product_id"], "left")
    product = F.aggregate(F.zip_with("u_factors", "i_factors", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    mean = F.coalesce(*[F.when(F.col("fold") == f, F.lit(m)) for f, m in means.items()] or [F.lit(None).cast("double")])
    zero = F.lit(0.0)
    value = mean + F.coalesce("u_bias", zero) + F.coalesce("i_bias", zero) + F.coalesce(product, zero)
    return joined.select("user_id", "product_id", "rating", F.least(F.greatest(value, F.lit(low)), F.lit(high)).alias("prediction"), "fold")


def fold_predictions(ratings: DataFrame, folds: int = 3, **options) -> DataFrame:
    """Held-out predictions of every rating: folds by ``hashed_fold``, a biased model without each."""
    dealt = cut_lineage(ratings.withColumn("fold", hashed_fold(F.col("user_id"), F.col("product_id"), folds)))
    model, means = fit_folds(dealt, folds, **options)
    return predict(dealt, model, means)


def by_blocks(keys: Sequence[int], blocks: int, spark) -> dict[int, int]:
    """The block of each key, as the strata see it: for checks of the descent on small data."""
    rows = spark.createDataFrame([(int(k),) for k in keys], "id long").select("id", _block(F.col("id"), blocks).alias("block"))
    return {r.id: r.block for r in rows.collect()}
