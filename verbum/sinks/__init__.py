"""Result writers (K1–K11): semicolon CSV with decimal commas, text logs
and partitioned trees.

All of them are DataFrame writes; nothing is gathered on the driver.  A
wide matrix is pivoted only over a column axis whose distinct values are
checked against ``max_columns`` first (categories, classes, components),
never over the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verbum.functions.joins import scalar

MAX_PIVOT_COLUMNS = 1000


def decimal_comma(c: Column | str, digits: int | None = None) -> Column:
    """Number → text with a decimal comma (``1,25``)."""
    c = F.col(c) if isinstance(c, str) else c
    if digits is not None:
        c = F.round(c, digits)
    return F.regexp_replace(c.cast("string"), r"\.", ",")


def _commas(df: DataFrame, digits: int | None) -> DataFrame:
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        out.append((decimal_comma(c, digits) if t in ("double", "float") or t.startswith("decimal") else c)
                   .alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, digits: int | None = None, sep: str = ";",
              header: bool = True, mode: str = "overwrite") -> None:
    """Semicolon CSV, doubles with decimal commas."""
    _commas(df, digits).write.mode(mode).option("sep", sep).option("header", header).csv(path)


def write_matrix(long: DataFrame, row: str, col: str, value: str, path: str,
                 digits: int | None = None, max_columns: int = MAX_PIVOT_COLUMNS, fill=0) -> None:
    """K1 / K4 / K9: long ``(row, col, value)`` → wide CSV with one column per
    distinct ``col``.  Refuses column axes wider than ``max_columns``."""
    n = scalar(long.agg(F.countDistinct(col).alias("n")), "n")
    if n > max_columns:
        raise ValueError(f"{n} distinct values of {col} exceed max_columns={max_columns}")
    wide = long.groupBy(row).pivot(col).agg(F.first(value)).na.fill(fill)
    write_csv(wide, path, digits)


def write_class_scores(scores: DataFrame, path: str, digits: int = 3) -> None:
    """K3: per-document class scores plus the winning class, one folder per
    class of the winner."""
    w = scores.groupBy("doc_id").agg(F.max_by("label", "score").alias("belongs_to"))
    out = scores.join(w, "doc_id")
    _commas(out, digits).write.mode("overwrite").partitionBy("belongs_to") \
        .option("sep", ";").option("header", True).csv(path)


def write_stage_log(tokens: DataFrame, path: str, token_col: str = "token") -> None:
    """K5: one line per sentence (tokens joined by spaces), files per
    document folder."""
    lines = (tokens.groupBy("doc_id", "sent_id")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", token_col))),
                                           lambda s: s[token_col]), " ").alias("value")))
    lines.repartition("doc_id").sortWithinPartitions("doc_id", "sent_id") \
        .select(F.col("doc_id").cast("string").alias("doc"), "value") \
        .write.mode("overwrite").partitionBy("doc").text(path)


def write_corpus_tree(corpus: DataFrame, path: str, text_col: str = "text") -> None:
    """K6: the (preprocessed) corpus mirrored as ``split=…/label=…`` folders."""
    corpus.select("split", "label", F.col(text_col).alias("value")) \
        .write.mode("overwrite").partitionBy("split", "label").text(path)


def write_class_probabilities(probs: DataFrame, path: str, digits: int = 3) -> None:
    """K7: ``(doc_id, label, probability)`` table."""
    write_csv(probs.select("doc_id", "label", "probability"), path, digits)


def write_itemsets(itemsets: DataFrame, path: str) -> None:
    """K8: itemsets / rules with arrays joined by ', ' and 3-digit rounding."""
    out = []
    for f in itemsets.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.simpleString().startswith("array"):
            c = F.array_join(c, ", ")
        out.append(c.alias(f.name))
    write_csv(itemsets.select(*out), path, digits=3)


def write_tfidf_log(weights: DataFrame, path: str) -> None:
    """Per word ``word; IDF; TF; IDF*TF``."""
    write_csv(weights.select("doc_id", F.col("term").alias("word"), "idf", "tf",
                             F.col("tfidf").alias("idf_tf")), path)


def write_clusters(assign: DataFrame, path: str) -> None:
    """Membership listing, one folder per cluster (noise is -1); a
    cluster of any size is written by many tasks, never gathered."""
    assign.select("cluster", F.col("doc_id").cast("string").alias("value")) \
        .write.mode("overwrite").partitionBy("cluster").text(path)
