"""N-gram Jaccard join of documents on five-word shingles, similarity 0.8 or more.

1. Texts with equal shingle sets are one node; a node has a 64-value MinHash signature.
2. Nodes that agree in one of 16 bands of 3 values are candidates (a pair of similarity 0.8
   agrees in none with probability 1e-5). Band groups are cut into cells of bounded size;
   in a cell the signatures are compared 16 values at a time, and a pair is dropped as soon as
   the posterior probability (uniform prior) that its similarity reaches 0.8 is below 1e-6.
   What is left of a cell is written as a spanning forest: at most one row per node.
3. Components of those forests hold all pairs that survived. Inside a component, again in
   bounded cells, shared shingles are counted exactly. Per node a cell returns the number of
   its links and its edge in a spanning forest of them, so rows grow with the nodes and not
   with the pairs, and no class falls apart.

Result: per row of the input its class (component of exact links) and its number of links.

Defined results: words are runs of ASCII letters, digits and any other non-ASCII characters,
lower-cased in A-Z; a text of one to four words is a single shingle; a null or wordless text
has no links and is a class of its own; equal rows link to each other; a null doc_id is a
member, but ``class_id`` is the smallest id there is in its class; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import release, small, unused
from tillwatch.llm.components import components
from tillwatch.llm.shingles import HASHES, minhash, set_key, shingle_sets
from tillwatch.session import written

THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS = 16
BAND_VALUES = 3
STEP = 16
# Nodes in one block of a band group; nodes and shingles in one block of a component.
BAND_BLOCK = 2048
NODE_BLOCK = 1024
SHINGLE_BLOCK = 400_000


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, matches below which a pair is dropped) after each step. With a uniform
    prior, P(similarity >= t | m of n match) is P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        keys, sizes, values = [], [], []
        for shingles in shingle_sets(batch.column("text")):
            keys.append(set_key(shingles))
            sizes.append(len(shingles))
            values.append(minhash(shingles) if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.string()),
             pa.array(sizes, pa.int64()), pa.array(values, pa.binary())],
            names=["doc_id", "text_hash", "set_key", "size", "signature"])


def _whole_groups(
    batches: Iterator[pd.DataFrame], keys: list[str], each: Callable[[pd.DataFrame], pd.DataFrame]
) -> Iterator[pd.DataFrame]:
    """Calls ``each`` on the rows so far whose groups are complete; rows come sorted by keys."""
    release()
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = (rows[keys] == rows[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = len(rows) - int(last[::-1].argmin() if not last.all() else len(rows))
        if cut:
            yield each(rows.iloc[:cut])
        held = rows.iloc[cut:]
    if held is not None and len(held):
        yield each(held)


def _group_ids(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    changed = (rows[keys] != rows[keys].shift()).any(axis=1).to_numpy()
    return np.cumsum(changed)


def _survivors(rows: pd.DataFrame) -> pd.DataFrame:
    """Spanning forest of the pairs that outlive the pruning in each cell."""
    group = _group_ids(rows, ["band", "bucket", "low", "high"])
    side = rows["block"].to_numpy()
    one_block = (rows["low"] == rows["high"]).to_numpy()
    values = np.frombuffer(b"".join(rows["signature"]), np.uint32).reshape(len(rows), HASHES)
    root = np.arange(len(rows))
    names = rows["set_key"].to_numpy()
    left, right = [], []
    limits = least_matches()

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    i, apart = np.arange(len(rows)), 1
    while True:
        i = i[i + apart < len(rows)]
        i = i[group[i] == group[i + apart]]
        if not len(i):
            break
        a = i[(one_block[i] | (side[i] != side[i + apart])) & (root[i] != root[i + apart])]
        done, matches = 0, np.zeros(len(a), np.int64)
        for upto, least in limits:
            matches += (values[a, done:upto] == values[a + apart, done:upto]).sum(axis=1)
            keep = matches >= least
            a, matches, done = a[keep], matches[keep], upto
        for x in a:
            p, q = top(x), top(x + apart)
            if p != q:
                root[max(p, q)] = min(p, q)
                left.append(names[x])
                right.append(names[x + apart])
        root = root[root]
        apart += 1
    return pd.DataFrame({"a": left, "b": right}, dtype=object)


def _links(rows: pd.DataFrame) -> pd.DataFrame:
    """Exact links in each cell: per node their number (copies included) and the partner that
    joins it to its tree in a spanning forest of the links (itself for a root)."""
    group = _group_ids(rows, ["component", "low", "high"])
    out = []
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        cell = rows.iloc[a:b]
        sets = [np.frombuffer(s, np.uint64) for s in cell["shingles"]]
        sizes = np.array([len(s) for s in sets], np.float64)
        weights = cell["copies"].to_numpy(np.float64)
        block = cell["block"].to_numpy()
        names = cell["set_key"].to_numpy()
        shared = _intersections(sets)
        linked = shared >= THRESHOLD * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
        np.fill_diagonal(linked, False)
        if cell["low"].iloc[0] != cell["high"].iloc[0]:
            linked &= block[:, None] != block[None, :]
        some = np.flatnonzero(linked.any(axis=1))
        if len(some):
            out.append(pd.DataFrame({
                "a": names[some], "b": names[_forest(linked)[some]],
                "links": (linked[some] @ weights).astype(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "links": []}).astype(
        {"a": object, "b": object, "links": np.int64})


def _forest(linked: np.ndarray) -> np.ndarray:
    """Spanning forest of a link matrix: the node from which each node is reached first, itself
    for the root of a tree. Any one partner per node would not do: in the path p - q - r - s
    both ends may be chosen by their neighbours, and the link between q and r is lost."""
    parent = np.full(len(linked), -1)
    for root in range(len(linked)):
        if parent[root] >= 0:
            continue
        parent[root], reached = root, [root]
        for node in reached:
            new = np.flatnonzero(linked[node] & (parent < 0))
            parent[new] = node
            reached.extend(new.tolist())
    return parent


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the number of shingles that each two sets share."""
    n = len(sets)
    all_values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(all_values, kind="stable")
    column = np.cumsum(np.diff(all_values[order], prepend=all_values[order][:1]) != 0)
    owner = owner[order]
    count = np.bincount(column)
    common = count[column] > 1
    column, owner = column[common], owner[common]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((n, n), np.float32)
    width = max(1, (1 << 22) // n)
    for first in range(0, int(column.max()) + 1 if len(column) else 0, width):
        here = (column >= first) & (column < first + width)
        present = np.zeros((n, width), np.float32)
        present[owner[here], column[here] - first] = 1
        out += present @ present.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out.astype(np.float64)


def _cells(members: DataFrame, blocks: str) -> DataFrame:
    """Deals the members of a group to ``blocks`` blocks by hash and pairs the blocks up."""
    return members.withColumn("blocks", F.expr(blocks).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn(
        "low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))


def _dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def document_sets(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, set_key, size and signature of every row, as a written table."""
    return written(
        documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
            _sets, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, text_hash long,"
            " set_key string, size long, signature binary"), "sets")


def candidates(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all pairs that survive the pruning."""
    bytes_ = 4 * BAND_VALUES
    banded = nodes.select("set_key", F.posexplode(F.expr(
        f"transform(sequence(0, {BANDS - 1}), i -> substring(signature, i * {bytes_} + 1, {bytes_}))"
    )).alias("band", "bucket"))
    crowded = banded.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = banded.join(crowded, ["band", "bucket"]).join(
        nodes.select("set_key", "signature"), "set_key")
    cells = _cells(members, f"ceil(members / {BAND_BLOCK})").select(
        "band", "bucket", "low", "high", "block", "set_key", "signature")
    keys = ["band", "bucket", "low", "high"]
    return _dealt(cells, keys).mapInPandas(
        lambda batches: _whole_groups(batches, keys, _survivors), "a string, b string")


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        found = [(set_key(s), s.tobytes()) for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.binary())],
            names=["set_key", "shingles"])


def exact_links(documents: DataFrame, nodes: DataFrame, grouped: DataFrame) -> DataFrame:
    """a, b (an edge of the cell's forest) and links of every node that has links, one row per cell."""
    sizes = nodes.join(grouped.withColumnRenamed("node", "set_key"), "set_key")
    totals = sizes.groupBy("component").agg(
        F.count(F.lit(1)).alias("members"), F.sum("size").alias("total"))
    asked = written(sizes.join(totals, "component").select(
        "set_key", "doc_id", "copies", "component", "members", "total"), "asked")
    wanted = asked.select(F.col("doc_id").alias("asked_id")).distinct()
    texts = documents.select("doc_id", "text").join(
        small(wanted), F.col("doc_id").eqNullSafe(F.col("asked_id")), "left_semi")
    shingled = texts.select("text").mapInArrow(_shingled, "set_key string, shingles binary")
    members = asked.join(shingled, "set_key").dropDuplicates(["set_key"])
    cells = _cells(members, f"greatest(ceil(members / {NODE_BLOCK}), ceil(total / {SHINGLE_BLOCK}))").select(
        "component", "low", "high", "block", "set_key", "copies", "shingles")
    keys = ["component", "low", "high"]
    return _dealt(cells, keys).mapInPandas(
        lambda batches: _whole_groups(batches, keys, _links), "a string, b string, links long")


def similar(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents``: doc_id, text_hash, ``class_key`` (names the class),
    ``class_id`` (its smallest doc_id) and ``n_links``, the number of other rows of similarity
    0.8 or more."""
    rows = document_sets(documents)
    nodes = written(rows.filter("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
        F.max("size").alias("size"), F.max("signature").alias("signature")), "nodes")
    survivors = written(candidates(nodes).distinct(), "survivors")
    links = written(exact_links(documents, nodes, components(survivors)), "links")
    counts = links.groupBy(F.col("a").alias("set_key")).agg(F.sum("links").alias("links"))
    linked = components(links.select("a", "b")).select(
        F.col("node").alias("set_key"), F.col("component").alias("class_key"))
    known = written(nodes.select("set_key", "doc_id", "copies").join(linked, "set_key", "left").join(
        counts, "set_key", "left").select(
        "set_key", "doc_id", F.coalesce("class_key", "set_key").alias("class_key"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    ids = known.groupBy("class_key").agg(F.min("doc_id").alias("class_id"))
    classes = known.drop("doc_id").join(ids, "class_key")
    alone = F.concat(F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                     F.lit("/"), F.coalesce(F.col("text_hash").cast("string"), F.lit("")))
    return rows.withColumn("set_key", F.coalesce("set_key", alone)).join(
        classes, "set_key", "left").select(
        "doc_id", "text_hash", F.coalesce("class_key", "set_key").alias("class_key"),
        F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("class_key").isNotNull().alias("has_words"))


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each class: the smallest doc_id (null last), then the
    smallest text hash. Rows without words all stay."""
    doc_id, text_hash, stays = unused(documents, "_id", "_hash", "stays")
    found = written(similar(documents), "similar")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    best = found.filter("has_words").groupBy("class_key").agg(F.min(order).alias("best"))
    rows = written(found.filter("has_words").join(best, "class_key").groupBy("doc_id", "text_hash").agg(
        F.max(order.eqNullSafe(F.col("best"))).alias("stays"), F.count(F.lit(1)).alias("n")
    ).filter("not stays or n > 1").select(
        F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash), F.col("stays").alias(stays)), "leaving")
    match = documents["doc_id"].eqNullSafe(F.col(doc_id)) & (F.xxhash64(documents["text"]) == F.col(text_hash))
    apart = documents.join(small(rows.select(doc_id, text_hash)), match, "left_anti")
    repeated = documents.join(small(rows.filter(stays)), match, "left_semi")
    return apart.unionByName(repeated.withColumn(text_hash, F.xxhash64("text")).dropDuplicates(
        ["doc_id", text_hash]).drop(text_hash))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "class_id", "n_links")
