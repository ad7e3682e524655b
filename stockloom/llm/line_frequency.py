"""Quality rules: text statistics, and lines that too many documents of a host share.

Only DataFrame functions. Normalised lines are hashed, each document counts once for each
of its lines, and the counts per host and line are summed before they are shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import sql_text, staged

STATISTICS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
)
# Bytes of changed documents, their keys and hashes of lines, that may be broadcast.
BROADCAST_BYTES = 64 << 20

# Repeated windows of a text that are looked up one after the other.
SHORT = 32

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


class Limits(NamedTuple):
    """When a line is boilerplate, and when a document is depleted without such lines.

    A line is removed if it is in more than ``share`` of a host's documents and in more than
    ``documents`` of them; copies of one text seldom reach such a share, and are left to
    deduplication. It is also removed if more than ``texts`` different texts of a host hold
    it, whatever their share, as a share alone is loosest in the largest hosts; exact copies
    of a text count once. A document is rejected if less than ``remaining`` of its lines'
    characters remain.

    Documents are counted by doc_id: rows that repeat one count once for a line and a host.
    Each row without a doc_id is a document.
    """

    share: float = 0.1
    documents: int = 20
    remaining: float = 0.3
    texts: int = 100


def _line_hash(line: str) -> str:
    """Case and spaces around a line do not distinguish it."""
    return f"xxhash64(lower(trim({line})))"


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    A null text counts as empty. n_repeat_words counts the words in three-word windows that
    occur twice or more; windows with equal 64-bit hashes are taken to be equal.
    """
    text = "coalesce(text, '')"
    symbols = r"[^#*$%&|<>]+"
    split = docs.withColumns(
        {
            "_words": F.expr(f"regexp_extract_all({text}, {sql_text(WORD)}, 0)"),
            "_lines": F.expr(f"filter(split({text}, '\\n', -1), x -> x rlike {sql_text(WORD)})"),
            "n_symbols": F.expr(
                f"cast(length(regexp_replace({text}, {sql_text(symbols)}, '')) as bigint)"
            ),
        }
    )
    places = "if(size(_words) < 3, array(), sequence(0, size(_words) - 3))"
    hashed = split.withColumns(
        {
            "n_words": F.expr("cast(size(_words) as bigint)"),
            "word_chars": F.expr("cast(length(array_join(_words, '')) as bigint)"),
            "n_dup_lines": F.expr("cast(size(_lines) - size(array_distinct(_lines)) as bigint)"),
            "_hashes": F.expr(
                f"transform({places}, i -> xxhash64(_words[i], _words[i + 1], _words[i + 2]))"
            ),
        }
    ).withColumn("_sorted", F.expr("sort_array(_hashes)"))
    repeated = "array_distinct(filter(_sorted, (x, k) -> k > 0 and x = _sorted[k - 1]))"
    # Where windows stand that occur again: looked up in a short list of repeated hashes;
    # or else hashes are sorted with their places, so that equal ones become neighbours.
    marked = hashed.withColumn("_again", F.expr(repeated)).withColumn(
        "_keyed",
        F.expr(
            f"if(size(_again) <= {SHORT}, array(),"
            " sort_array(transform(_hashes, (x, i) -> concat(x, ':', i))))"
        ),
    ).withColumn("_keys", F.expr("transform(_keyed, x -> substring_index(x, ':', 1))"))
    listed = "filter(transform(_hashes, (x, i) -> if(array_contains(_again, x), i, null)), p -> p is not null)"
    neighbours = (
        "sort_array(filter(transform(_keyed, (x, k) -> if(_keys[k] = get(_keys, k - 1) or"
        " _keys[k] = get(_keys, k + 1), int(substring_index(x, ':', -1)), null)),"
        " p -> p is not null))"
    )
    placed = marked.withColumn(
        "_places",
        F.expr(
            "case when size(_again) = 0 then cast(array() as array<int>)"
            f" when size(_again) <= {SHORT} then {listed} else {neighbours} end"
        ),
    )
    # Each place covers three words, less those that the place before covers already.
    covered = "transform(_places, (p, k) -> if(k = 0, 3, least(3, p - _places[k - 1])))"
    return (
        placed.withColumn(
            "n_repeat_words", F.expr(f"aggregate({covered}, 0L, (acc, x) -> acc + x)")
        )
        .withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
        .drop("_words", "_hashes", "_sorted", "_again", "_keyed", "_keys", "_places")
    )


def _host(docs: DataFrame) -> Column:
    return F.coalesce(F.col("source"), F.lit("")) if "source" in docs.columns else F.lit("")


KEY = ["doc_id", "host", "text_hash"]


def _measured(docs: DataFrame) -> DataFrame:
    """Per row its key, statistics and, for each line with a word, hash and length."""
    own = docs.select("doc_id", _host(docs).alias("host"), "text")
    lines = f"transform(_lines, x -> named_struct('line', {_line_hash('x')}, 'chars', length(x)))"
    return text_statistics(own).select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        *STATISTICS,
        F.expr(lines).alias("lines"),
    )


def _by_document(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose doc_id is theirs alone or null, and rows that share one."""
    ids = rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    ids = staged(ids.select("doc_id"), "repeated-ids")
    return rows.join(ids, "doc_id", "left_anti"), rows.join(ids, "doc_id", "left_semi")


def frequent_lines(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(host, line, n_docs) of the lines above the limits, from the rows of documents."""
    distinct = F.expr("array_distinct(transform(lines, x -> x.line))").alias("each")
    slim = measured.select("doc_id", "host", "text_hash", distinct)
    alone, shared = _by_document(slim)
    hosts = alone.select("host").unionByName(shared.select("doc_id", "host").distinct().select("host"))
    per_host = hosts.groupBy("host").agg(F.count("*").alias("host_docs"))
    # Only lines of repeated ids need their document beside them to be counted.
    rows = shared.select("doc_id", "host", F.explode("each").alias("line"))
    counted = (
        alone.select("host", F.explode("each").alias("line"), F.lit(1).alias("d"), F.lit(1).alias("r"))
        .unionByName(rows.select("host", "line", F.lit(0).alias("d"), F.lit(1).alias("r")))
        .unionByName(rows.distinct().select("host", "line", F.lit(1).alias("d"), F.lit(0).alias("r")))
        .groupBy("host", "line")
        .agg(F.sum("d").alias("n_docs"), F.sum("r").alias("n_rows"))
        .filter((F.col("n_docs") > limits.documents) | (F.col("n_rows") > limits.texts))
    )
    above = (F.col("n_docs") > limits.documents) & (
        F.col("n_docs") > limits.share * F.col("host_docs")
    )
    judged = staged(counted.join(per_host, "host").withColumn("above", above), "counted")
    # Only lines in so many rows can be in so many texts.
    open_lines = judged.filter(~F.col("above") & (F.col("n_rows") > limits.texts))
    wide = (
        slim.select("host", "text_hash", F.explode("each").alias("line"))
        .join(open_lines.select("host", "line", "n_docs"), ["host", "line"])
        .groupBy("host", "line", "text_hash")
        .agg(F.first("n_docs").alias("n_docs"))
        .groupBy("host", "line")
        .agg(F.first("n_docs").alias("n_docs"), F.count("*").alias("n_texts"))
        .filter(F.col("n_texts") > limits.texts)
    )
    columns = ["host", "line", "n_docs"]
    return judged.filter("above").select(*columns).unionByName(wide.select(*columns))


def _same_key(left: DataFrame, right: DataFrame) -> Column:
    """Equal keys; a null doc_id equals a null one."""
    return (
        left.doc_id.eqNullSafe(right.doc_id)
        & (left.host == right.host)
        & (left.text_hash == right.text_hash)
    )


def _judged(docs: DataFrame, limits: Limits) -> DataFrame:
    measured = staged(_measured(docs), "measured")
    frequent = staged(frequent_lines(measured, limits).select("host", "line"), "frequent")
    distinct = F.expr("array_distinct(transform(lines, x -> x.line))")
    removed = (
        measured.select(*KEY, F.explode(distinct).alias("line"))
        .join(frequent, ["host", "line"])
        .groupBy(*KEY)
        .agg(F.collect_set("line").alias("removed"))
    )
    total = "aggregate(lines, 0L, (acc, x) -> acc + x.chars)"
    lost = (
        "if(removed is null, 0L, aggregate(lines, 0L, (acc, x) ->"
        " acc + if(array_contains(removed, x.line), x.chars, 0)))"
    )
    return (
        measured.join(removed, _same_key(measured, removed), "left")
        .select(measured["*"], "removed")
        .withColumn("line_chars", F.expr(total))
        .withColumn("lost_chars", F.expr(lost))
        .withColumn(
            "kept",
            F.expr(
                "not base_failed and"
                f" line_chars - lost_chars >= {limits.remaining} * line_chars"
            ),
        )
    )


def quality_verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, line_chars, lost_chars, kept.

    ``docs`` has doc_id and text, and source as host; a missing or null source is the empty
    host. line_chars counts the characters of lines with a word, lost_chars those of removed
    lines among them. A null or wordless text has no words and fails. Repeated rows are one
    document to the counts of lines, and each gets its verdict. A null doc_id stays null.
    Other columns are ignored.
    """
    return _judged(docs, limits).select("doc_id", *STATISTICS, "line_chars", "lost_chars", "kept")


def quality_filtered(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` without rejected documents, and without the lines above the limits.

    Texts without such lines stay as they are, byte for byte. Columns and order are kept.
    """
    changes = staged(
        _judged(docs, limits)
        .filter("not kept or removed is not null")
        .select(*KEY, "kept", "removed")
        .dropDuplicates(KEY),
        "changes",
    )
    size = F.sum(F.lit(64) + F.length("host") + 8 * F.coalesce(F.size("removed"), F.lit(0)))
    if (changes.agg(size).first()[0] or 0) <= BROADCAST_BYTES:
        changes = F.broadcast(changes)
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"),
        "doc_id",
        _host(docs).alias("host"),
        F.xxhash64("text").alias("text_hash"),
    )
    joined = keyed.join(changes, _same_key(keyed, changes), "left")
    rest = (
        "array_join(filter(split(row.text, '\\n', -1), x -> not array_contains(removed,"
        f" {_line_hash('x')})), '\\n')"
    )
    text = F.expr(f"if(removed is null, row.text, {rest})").alias("text")
    return joined.filter("coalesce(kept, true)").select(
        *(text if name == "text" else F.col("row")[name].alias(name) for name in docs.columns)
    )
