"""Benchmark decontamination: hits of benchmark word windows in documents.

The benchmark's windows are a hash set that is broadcast after a check of its size. Documents
are scanned in steps of s words: a window of L words that starts in such a step holds the run
of ``L + 1 - s`` words from word ``s - 1`` of the step on, so looking up that one run for each
step misses no window. Each step carries the words in which its windows lie, so that after a
find every one of them is compared word for word. Only DataFrame functions are used.

Words are lower-cased in A-Z alone. The first look-up uses ``lower()`` on both sides, which
can only add finds; the exact comparison that follows uses the A-Z rule.

Defined results: a null or empty text has no words and no hits; an item without words has no
window; repeated items and repeated documents each count as themselves (an ``item_id`` is
listed once per document); a null ``item_id`` is ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import small, unused
from tillwatch.session import written

WINDOW = 10
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_AND_REST = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
BEFORE_WORDS = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words in order, their case unchanged. Null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NOT_WORD), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def run_length(length: int) -> int:
    """Words of a looked-up run for windows of ``length`` words: enough to be rare."""
    return max(min(length, 3), length * 2 // 5)


def step(length: int) -> int:
    """Distance of the looked-up runs: the most at which each window still holds one."""
    return length + 1 - run_length(length)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per distinct window: ``length``, ``text`` (its words joined by a space), the
    ``items`` that hold it. An item with fewer words than ``window`` is one window."""
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")
    ).filter("item is not null and size(w) > 0")
    parts = words.select(
        "item", F.expr(f"least(size(w), {window})").alias("length"),
        F.explode(F.expr(
            f"transform(sequence(1, size(w) - least(size(w), {window}) + 1),"
            f" i -> array_join(slice(w, i, {window}), ' '))"
        )).alias("raw"),
    )
    return (
        parts.withColumn("text", ascii_lower(F.col("raw")))
        .groupBy("length", "text").agg(F.collect_set("item").alias("items"))
    )


def _steps(length: int) -> str:
    """The steps of ``words`` for one window length, each with the words of its windows."""
    return (
        f"transform(if(size(words) >= {length}, sequence(0, size(words) - {length}, {step(length)}),"
        f" cast(array() as array<int>)), c -> struct({length} as length, c as start,"
        f" slice(words, c + 1, {length + step(length) - 1}) as near))"
    )


def find_windows(documents: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences of windows: per document (``keys``) a row for each window found, with its
    first word ``start``, ``length`` and ``items``; and one row with ``length`` 0 that has the
    document's word count in ``n_words``. That row's text starts with a space, as no window
    does, and differs by document, so that it finds nothing and overloads no task."""
    lengths = sorted(row["length"] for row in windows.select("length").distinct().collect())
    runs = written(windows.select("length", F.explode(F.expr(
        "transform(sequence(1, length + 1 - greatest(least(length, 3), cast(length * 2 div 5 as int))),"
        " o -> slice(split(text, ' '), o, greatest(least(length, 3), cast(length * 2 div 5 as int))))"
    )).alias("run")).select("length", F.lower(F.array_join("run", " ")).alias("text")).distinct(),
        "runs")
    count = (
        "array(struct(0 as length, size(words) as start,"
        f" array(concat(' ', cast(xxhash64({', '.join(keys)}) as string))) as near))"
    )
    steps = F.expr(f"concat({', '.join([count, *map(_steps, lengths)])})")
    looked_up = (
        documents.select(*keys, words_of(F.col("text")).alias("words"))
        .select(*keys, F.explode(steps).alias("step")).select(*keys, "step.*")
        .withColumn("text", F.expr(
            "if(length = 0, near[0], lower(array_join(slice(near,"
            " length + 1 - greatest(least(length, 3), cast(length * 2 div 5 as int)),"
            " greatest(least(length, 3), cast(length * 2 div 5 as int))), ' ')))"))
        .join(small(runs).withColumn("known", F.lit(True)), ["length", "text"], "left")
        .filter("known or length = 0")
    )
    tried = looked_up.select(*keys, "length", F.explode(F.expr(
        "if(length = 0, array(struct(start, text)),"
        " transform(sequence(0, size(near) - length), o -> struct("
        " start + o as start, array_join(slice(near, o + 1, length), ' ') as text)))"
    )).alias("try")).select(*keys, "length", "try.start", ascii_lower(F.col("try.text")).alias("text"))
    return tried.join(small(windows), ["length", "text"], "left").filter(
        "items is not null or length = 0"
    ).select(*keys, "length", "items",
             F.expr("if(length = 0, null, start)").alias("start"),
             F.expr("if(length = 0, start, null)").alias("n_words"))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``documents``: doc_id, ``text_hash`` (which tells apart texts that
    share an id), n_words, n_hit, n_items, items (sorted strings) and spans, the hit words as
    ascending [first, end) pairs."""
    keys = ["doc_id", "text_hash"]
    source = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    windows = written(benchmark_windows(benchmark, window), "windows")
    found = find_windows(source, windows, keys)
    grouped = found.groupBy(*keys).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count("n_words").alias("copies"),
        F.array_sort(F.collect_set(F.expr(
            "if(start is null, null, struct(start as first, start + length as end))"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    merged = F.expr(
        "aggregate(hits, cast(array() as array<struct<first:int,end:int>>), (done, h) ->"
        " if(size(done) > 0 and element_at(done, -1).end >= h.first,"
        " concat(slice(done, 1, size(done) - 1), array(named_struct('first',"
        " element_at(done, -1).first, 'end', greatest(element_at(done, -1).end, h.end)))),"
        " concat(done, array(named_struct('first', h.first, 'end', h.end)))))"
    )
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.first)")
    # Equal rows met in one group; each is given back.
    return (
        grouped.withColumn("spans", merged).withColumn("n_hit", hit)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*keys, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                "items", "spans")
    )


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, remove: str = "documents"
) -> DataFrame:
    """``documents`` without contaminated rows (``remove="documents"``), or with the hit words
    and the separators after them cut from the text (``remove="spans"``). Columns and clean
    rows stay as they are."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: documents or spans, not {remove}")
    doc_id, text_hash, spans = unused(documents, "_id", "_hash", "_spans")
    found = written(
        contamination(documents, benchmark, window).filter("n_hit > 0")
        .select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash), F.col("spans").alias(spans))
        .distinct(), "contaminated")
    match = documents["doc_id"].eqNullSafe(F.col(doc_id)) & (F.xxhash64(documents["text"]) == F.col(text_hash))
    if remove == "documents":
        return documents.join(small(found), match, "left_anti")
    pieces = F.regexp_extract_all(F.col("text"), F.lit(WORD_AND_REST), F.lit(0))
    kept = F.filter(pieces, lambda piece, i: ~F.exists(
        F.col(spans), lambda s: (i >= s["first"]) & (i < s["end"])))
    cut = F.concat(F.regexp_extract("text", BEFORE_WORDS, 0), F.array_join(kept, ""))
    return documents.join(small(found), match, "left").withColumn(
        "text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(cut)
    ).select(*documents.columns)
