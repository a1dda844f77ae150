"""Vectors: exact search, neighbours and the greedy removal of near duplicates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from tidemark.operators import tables
from tidemark.session import stage, unstage
from tidemark.sources.stages import read_or_empty, replace_table

#: Queries multiplied with the whole table at a time.
BLOCK = 2048
#: Rows of a cluster that one task takes.
CLUSTER = 100_000


def _matrix(column: pa.ListArray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors of that many dimensions in a batch, and the vectors as rows of a matrix."""
    column = column.cast(pa.list_(pa.float64()))
    size = np.diff(column.offsets.to_numpy())
    fits = np.flatnonzero((size == dims) & column.is_valid().to_numpy(zero_copy_only=False))
    start = column.offsets.to_numpy()[:-1][fits]
    return fits, column.values.to_numpy(zero_copy_only=False)[start[:, None] + np.arange(dims)]


def _best(similarity: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n greatest, ties by id."""
    if len(ids) > 4 * n:
        near = np.flatnonzero(similarity >= np.partition(similarity, -n)[-n])
        return near[np.lexsort((ids[near], -similarity[near]))[:n]]
    return np.lexsort((ids, -similarity))[:n]


def search(vectors: DataFrame, query: list[float], top_k: int, id_col: str = "vec_id", least: float | None = None, keep: Column | None = None, exact: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, carried columns, similarity and distance of the nearest rows by cosine: the first min(3 top_k, 10000), then the filters, then top_k.

    With exact the filters come first, which can only find more. A threshold of None or 0 is none. Ties go by id. Null
    vectors, those of other dimensions and of zeros are at no distance and never found. Only the best of each batch
    leave Python.
    """
    q = np.array(query, np.float64)
    first = top_k if exact else min(3 * top_k, 10_000)
    rows = vectors.select(id_col, *carry, F.col("embedding").alias("_vector"), (F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))).alias("_keep"))
    schema = StructType([*(f for f in rows.schema.fields if f.name not in ("_vector", "_keep")), StructField("_keep", BooleanType()), StructField("similarity", DoubleType())])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, m = _matrix(batch.column("_vector"), len(q))
            norm = np.linalg.norm(m, axis=1) * np.linalg.norm(q)
            sim = np.round(np.divide(m @ q, norm, out=np.full(len(at), np.nan), where=norm > 0), 6)
            ok = norm > 0
            if exact:
                ok &= batch.column("_keep").to_numpy(zero_copy_only=False)[at].astype(bool)
                ok &= sim >= least if least else True
            at, sim = at[ok], sim[ok]
            top = _best(sim, batch.column(id_col).to_numpy(zero_copy_only=False)[at], first)
            out = batch.take(pa.array(at[top]))
            yield pa.RecordBatch.from_arrays([*(out.column(c) for c in (id_col, *carry, "_keep")), pa.array(sim[top])], names=[id_col, *carry, "_keep", "similarity"])

    found = rows.mapInArrow(nearest, schema).withColumn("distance", F.round(1 - F.col("similarity"), 6))
    if not exact:
        found = found.orderBy("distance", id_col).limit(first).where(F.col("_keep") & (F.lit(True) if not least else F.col("similarity") >= least))
    return found.drop("_keep").orderBy("distance", id_col).limit(top_k)


def both_searches(first: DataFrame, second: DataFrame, top_k: int, id_col: str = "vec_id") -> DataFrame:
    """Hits of the first search that the second found too, with the first's order and scores."""
    return first.join(second.select(id_col), id_col, "left_semi").orderBy("distance", id_col).limit(top_k)


def neighbours(queries: DataFrame, corpus: DataFrame, k: int, id_col: str = "vec_id") -> DataFrame:
    """query_id, id, similarity, rank of the k nearest corpus rows of each query, by matrix products.

    Queries come in blocks; each block meets every batch of the corpus once, and only the k best of a partition leave it.
    Null vectors have no neighbours; a vector of zeros is at similarity 0 of all.
    """
    parts = None
    for ids, q in _query_blocks(queries, id_col):

        def run(pdfs: Iterator[pd.DataFrame], ids: np.ndarray = ids, q: np.ndarray = q) -> Iterator[pd.DataFrame]:
            best_id, best = np.empty((len(ids), 0), np.int64), np.empty((len(ids), 0))
            for pdf in pdfs:
                pdf = pdf[pdf["embedding"].notna()]
                if not len(pdf):
                    continue
                own = pdf[id_col].to_numpy(np.int64)
                sim = np.concatenate([best, np.round(q @ _unit(np.stack(pdf["embedding"].to_numpy()).astype(np.float64)).T, 6)], axis=1)
                who = np.concatenate([best_id, np.broadcast_to(own, (len(ids), len(own)))], axis=1)
                top = np.lexsort((who, -sim), axis=1)[:, :k]  # ties by id
                best, best_id = np.take_along_axis(sim, top, 1), np.take_along_axis(who, top, 1)
            if best.shape[1]:
                yield pd.DataFrame({"query_id": np.repeat(ids, best.shape[1]), "id": best_id.ravel(), "similarity": best.ravel()})

        part = corpus.select(id_col, "embedding").mapInPandas(run, "query_id bigint, id bigint, similarity double")
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        parts = corpus.sparkSession.createDataFrame([], "query_id bigint, id bigint, similarity double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return parts.withColumn("rank", rank).where(F.col("rank") <= k)


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def _query_blocks(queries: DataFrame, id_col: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids, vecs = [], []
    for r in queries.where("embedding is not null").select(id_col, "embedding").toLocalIterator():
        ids.append(r[0]), vecs.append(r[1])
        if len(ids) == BLOCK:
            yield np.array(ids), _unit(np.array(vecs, np.float64))
            ids, vecs = [], []
    if ids:
        yield np.array(ids), _unit(np.array(vecs, np.float64))


def upsert_vectors(spark: SparkSession, path: str, new: DataFrame, key: str = "article_id") -> None:
    """The table at path with the new vectors over those of the same key: one vector a key, however often it is embedded."""
    old = read_or_empty(spark, path, new.schema)
    replace_table(tables.upsert(old.select(*new.columns), new, key, "model"), path)


#: Vectors that the centres of an index are fitted on at most, and rounds of the fit.
FIT_ROWS, FIT_ROUNDS = 20_000, 12


def fit_centres(vectors: DataFrame, clusters: int = 64, id_col: str = "vec_id") -> np.ndarray:
    """Unit centres of clusters, fitted on at most FIT_ROWS vectors drawn by hash; every vector is indexed, though."""
    rows = vectors.where("embedding is not null")
    n = rows.count()
    if n > FIT_ROWS:
        rows = rows.where(F.pmod(F.xxhash64(id_col, F.lit("fit")), F.lit(1 << 20)) < int(1.1 * FIT_ROWS / n * (1 << 20)) + 1).limit(FIT_ROWS)
    got = rows.select("embedding").toPandas()["embedding"]
    if not len(got):
        return np.zeros((1, 1))
    dims = int(got.map(len).mode()[0])  # vectors of other dimensions are in no index
    m = _unit(np.stack([x for x in got if len(x) == dims]).astype(np.float64))
    rng = np.random.default_rng(7)
    centres = m[rng.choice(len(m), min(clusters, len(m)), replace=False)]
    for _ in range(FIT_ROUNDS):
        near = np.argmax(m @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, m)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), centres)
    return centres


def indexed(vectors: DataFrame, centres: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """id, embedding, cluster of every vector: that of the nearest centre. Written by cluster, a search reads few of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, m = _matrix(batch.column("embedding"), centres.shape[1])
            near = np.argmax(_unit(m) @ centres.T, axis=1) if len(at) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(id_col).take(pa.array(at)), batch.column("embedding").take(pa.array(at)), pa.array(near.astype(np.int32))], names=[id_col, "embedding", "cluster"])

    rows = vectors.select(id_col, "embedding")
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("cluster", IntegerType())]))


def write_index(vectors: DataFrame, path: str, clusters: int = 64, id_col: str = "vec_id") -> np.ndarray:
    """An index of the vectors as a table by cluster; returns the centres."""
    centres = fit_centres(vectors, clusters, id_col)
    indexed(vectors, centres, id_col).write.mode("overwrite").partitionBy("cluster").parquet(path)
    return centres


def probes_for(index: DataFrame, centres: np.ndarray, k: int = 10, recall: float = 0.95, queries: int = 100, id_col: str = "vec_id") -> int:
    """The fewest clusters to look into for this recall, measured on so many indexed vectors, drawn by hash, against exact neighbours among all."""
    asked = index.orderBy(F.xxhash64(id_col, F.lit("probe")), id_col).limit(queries).select(id_col, "embedding")
    exact = neighbours(asked, index, k, id_col).join(index.select(F.col(id_col).alias("id"), "cluster"), "id").select("query_id", "cluster").toPandas()  # at most k a query
    if not len(exact):
        return len(centres)
    own = asked.toPandas()
    order = np.argsort(-(_unit(np.stack(own["embedding"].to_numpy()).astype(np.float64)) @ centres.T), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    rank = place[[dict(zip(own[id_col], range(len(own))))[q] for q in exact["query_id"]], exact["cluster"]]
    return int(np.sort(rank)[min(len(rank) - 1, int(np.ceil(recall * len(rank))) - 1)]) + 1


def search_index(index: DataFrame, centres: np.ndarray, query: list[float], top_k: int, probes: int, **how) -> DataFrame:
    """As search with exact filters, over the clusters nearest to the query only; with probes of all clusters it is exact."""
    nearest = np.argsort(-(centres @ np.array(query, np.float64)), kind="stable")[:probes]
    return search(index.where(F.col("cluster").isin([int(c) for c in nearest])), query, top_k, exact=True, **how)


def near_neighbours(queries: DataFrame, index: DataFrame, centres: np.ndarray, k: int, probes: int, id_col: str = "vec_id") -> DataFrame:
    """query_id, id, similarity, rank of the k nearest in the clusters nearest to each query: queries and rows of a cluster meet.

    Rows of a large cluster are salted over tasks of at most CLUSTER rows, and each task's best are merged, so that no
    task has a whole hot cluster.
    """
    sizes = index.groupBy("cluster").agg(F.ceil(F.count("*") / CLUSTER).cast("int").alias("salts"))

    def nearest(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            pdf = pdf[[x is not None and len(x) == centres.shape[1] for x in pdf["embedding"]]]
            if len(pdf):
                near = np.argsort(-(_unit(np.stack(pdf["embedding"].to_numpy()).astype(np.float64)) @ centres.T), axis=1, kind="stable")[:, :probes]
                yield pd.DataFrame({"id": np.repeat(pdf[id_col].to_numpy(np.int64), near.shape[1]), "embedding": [x for x in pdf["embedding"] for _ in range(near.shape[1])], "cluster": near.ravel().astype(np.int32)})

    asked = queries.select(id_col, "embedding").mapInPandas(nearest, "id bigint, embedding array<float>, cluster int").join(sizes, "cluster")
    asked = asked.select("cluster", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "id", "embedding")
    held = index.join(sizes, "cluster").select("cluster", F.pmod(F.xxhash64(id_col), "salts").cast("int").alias("salt"), F.col(id_col).alias("id"), "embedding")

    def meet(key: tuple, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "id": [], "similarity": []})
        ids, m = c["id"].to_numpy(np.int64), _unit(np.stack(c["embedding"].to_numpy()).astype(np.float64))
        out = []
        for i in range(0, len(q), 256):
            sim = np.round(_unit(np.stack(q["embedding"].iloc[i : i + 256].to_numpy()).astype(np.float64)) @ m.T, 6)
            for who, row in zip(q["id"].iloc[i : i + 256], sim):
                top = _best(row, ids, k)
                out.append(pd.DataFrame({"query_id": who, "id": ids[top], "similarity": row[top]}))
        return pd.concat(out)

    found = asked.groupBy("cluster", "salt").cogroup(held.groupBy("cluster", "salt")).applyInPandas(meet, "query_id bigint, id bigint, similarity double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def greedy_distinct(rows: DataFrame, k: int = 20, above: float = 0.85, near: DataFrame | None = None) -> DataFrame:
    """pos, kept id of the greedy choice among rows (id, ord, length, embedding); near: query_id, id, similarity, rank, if known.

    By definition one row after the other in input order: a row not seen yet and its neighbours, seen or not, give their
    longest (the first of several), all of them count as seen, and a longest seen before is not told again. So a row has its
    turn if no earlier row with a turn has it as a neighbour, and its longest is told if no earlier turn's group holds that.
    The first is decided in rounds for all rows whose earlier neighbours are decided, the second by a minimum: no task
    has more than a share of the rows. Ties in ord go by id. Rows without a vector have no neighbours.
    """
    if near is None:
        ids = rows.select(F.col("id").alias("vec_id"), "embedding")
        near = neighbours(ids, ids, k)
    own = stage(rows.select("id", F.struct("ord", "id").alias("o"), "length"), "rows")
    known = near.where(f"similarity > {above} and query_id <> id")
    edges = known.select(F.col("query_id").alias("src"), F.col("id").alias("dst"), "rank")
    edges = edges.join(own.select(F.col("id").alias("src"), F.col("o").alias("src_o")), "src").join(own.select(F.col("id").alias("dst"), F.col("o").alias("dst_o"), F.col("length").alias("dst_length")), "dst")
    edges = stage(edges, "edges")
    before = edges.where("src_o < dst_o").select("src", "dst")
    state = own.select("id", F.lit(None).cast("boolean").alias("turn"))
    rounds = 0
    while True:
        told = before.join(state.select(F.col("id").alias("src"), "turn"), "src").groupBy(F.col("dst").alias("id")).agg(F.max(F.coalesce("turn", F.lit(False))).alias("taken"), F.max(F.col("turn").isNull()).alias("open"))
        now = F.when(F.col("turn").isNotNull(), F.col("turn")).when(F.col("taken"), False).when(~F.coalesce("open", F.lit(False)), True)
        done, state = state, stage(state.join(told, "id", "left").select("id", now.alias("turn")), "turns")
        if rounds:
            unstage(done)
        rounds += 1
        if state.where("turn is null").isEmpty():
            break
    turns = state.where("turn").select("id").join(own, "id")
    members = turns.select(F.col("id").alias("src"), F.col("o").alias("src_o"), F.col("id").alias("dst"), "length", F.lit(0).alias("rank"))
    members = members.unionByName(edges.join(turns.select(F.col("id").alias("src")), "src", "left_semi").select("src", "src_o", "dst", F.col("dst_length").alias("length"), "rank"))
    members = stage(members, "groups")
    first = members.groupBy(F.col("dst").alias("best")).agg(F.min("src_o").alias("first"))
    best = members.groupBy("src").agg(F.max_by("dst", F.struct("length", -F.col("rank"))).alias("best"), F.first("src_o").alias("src_o"))
    kept = best.join(first, "best").where(F.col("first") == F.col("src_o")).select(F.col("src_o.ord").alias("ord"), F.col("src").alias("by"), F.col("best").alias("id"))
    return tables.numbered(kept, "ord", "by").select(F.col("position").cast("bigint").alias("pos"), "id")
