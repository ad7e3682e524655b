"""Personal data by patterns, and by contexts that those patterns teach.

Only DataFrame functions. Base matches of fixed patterns are the seeds. Tokens with digits
and spelled-out addresses near words are candidates; the words around seeds and candidates are lexical patterns. A
graph of patterns and instances is scored in rounds: a pattern counts by the share of its
instances that are believed, an instance by the patterns it occurs in. Candidates that good
patterns vouch for become spans of the pattern's kind.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.arrays import running
from stockloom.llm.common import sql_text, staged

KINDS = ("email", "ip", "card", "phone")

# The kinds' definitions. Possessive loops and the condition on where a match may begin
# find what the plain definitions find, in linear time and without recursion: inside a run
# of such characters no later start can match if the first one cannot.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must contain to be searched at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
# Digit-bearing tokens, also several with one space between them.
# MASK stands for what base matches cover; tokens of which they cover a part are left out.
MASK = r"\x{FFFF}"
_TOKEN = rf"[^\x20\x09-\x0D0-9{MASK}]*+[0-9][^\x20\x09-\x0D{MASK}]*+(?![^\x20\x09-\x0D])"
CANDIDATE = rf"(?<![^\x20\x09-\x0D]){_TOKEN}(?:\x20{_TOKEN})*+"
# Addresses with or without digits: a word, an at sign or a spelling of it, and a host, which
# must have a dot or a spelling of it after a bare "at".
_HOST = r"[A-Za-z0-9-]++"
_DOT = r"(?:\.|\x20dot\x20|\x20?\[dot\]\x20?|\x20?\(dot\)\x20?)"
ADDRESS = (
    rf"(?i)(?<![{_LOCAL}{MASK}])[a-z0-9_][{_LOCAL}]*+"
    rf"(?:(?:@|\x20?\[at\]\x20?|\x20?\(at\)\x20?){_HOST}(?:{_DOT}{_HOST})*+"
    rf"|\x20at\x20{_HOST}(?:{_DOT}{_HOST})++)(?![{MASK}@])"
)
# Characters of context that may hold the two words on each side.
CONTEXT = 48


class Bootstrap(NamedTuple):
    """Rounds of scoring and what is believed.

    A pattern is used if ``support`` different instances of a kind are believed in it and
    its smoothed share of believed instances is ``confidence``; a candidate is accepted at
    ``accept``, at which it takes two good patterns or one excellent one.
    """

    rounds: int = 2
    support: int = 3
    smoothing: float = 1.0
    confidence: float = 0.6
    accept: float = 0.9


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _luhn(value: str) -> str:
    """Whether the digits of ``value``, doubled at every second from the right, sum to 0 mod 10."""
    parts = f"split(reverse({_digits(value)}), '')"
    doubled = "if(i % 2 = 0, int(d), int(d) * 2 - if(int(d) > 4, 9, 0))"
    return (
        f"aggregate(transform(filter({parts}, c -> c <> ''), (d, i) -> {doubled}), 0,"
        " (acc, v) -> acc + v) % 10 = 0"
    )


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
VALID = {
    "email": "true",
    "ip": rf"x.value rlike {sql_text(rf'^{_OCTET}(?:[.]{_OCTET}){{3}}$')}",
    "card": f"length({_digits('x.value')}) between 12 and 19 and {_luhn('x.value')}",
    "phone": f"length({_digits('x.value')}) between 9 and 15",
}
# Which candidates can be of a kind at all.
PLAUSIBLE = {
    "email": r"value rlike '[A-Za-z]' and value rlike '(?i)@| at |\\[at\\]|\\(at\\)'",
    "ip": r"regexp_count(value, '[0-9]+') = 4 and value rlike '^[0-9][0-9.,:_-]+[0-9]$'",
    "card": f"length({_digits('value')}) between 12 and 19",
    "phone": f"length({_digits('value')}) between 7 and 15",
}


def _located(pattern: str, needs: str, text: str = "text") -> tuple[dict, dict, str]:
    """Columns, in three steps, that end in an array of (start, end, value, before, after)."""
    quoted = sql_text(pattern)
    some = f"coalesce({text}, '') rlike {sql_text(needs)}"
    first = {
        "_found": f"if({some}, regexp_extract_all({text}, {quoted}, 0), cast(array() as array<string>))",
        "_gaps": f"if({some}, split({text}, {quoted}, -1), cast(array() as array<string>))",
    }
    second = {
        "_lens": "zip_with(_found, slice(_gaps, 1, size(_found)), (f, g) -> length(g) + length(f))"
    }
    starts = running("_lens", "0", "acc + v")
    third = (
        f"transform(zip_with(_found, {starts}, (f, s) -> named_struct('f', f, 's', s)), (z, i) ->"
        " named_struct('start', z.s + length(_gaps[i]), 'end',"
        " z.s + length(_gaps[i]) + length(z.f), 'value', z.f,"
        f" 'before', right(_gaps[i], {CONTEXT}), 'after', left(_gaps[i + 1], {CONTEXT})))"
    )
    return first, second, third


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with an array of (start, end, value, before, after) per kind, and of candidates.

    Positions are code points, ends exclusive. A null text has none.
    """
    for kind in KINDS:
        docs = _with_located(docs, kind, PATTERNS[kind], NEEDS[kind])
        docs = docs.withColumn(kind, F.expr(f"filter({kind}, x -> {VALID[kind]})"))
    docs = _with_masked(docs)
    docs = _with_located(docs, "_numbers", CANDIDATE, "[0-9]", "_masked")
    docs = _with_located(docs, "_addresses", ADDRESS, r"(?i)@| at |[\[(]at[\])]", "_masked")
    # A few digits are no identifier.
    numbers = "filter(_numbers, c -> regexp_count(c.value, '[0-9]') >= 4)"
    # What is masked is one word of a context.
    plain = "regexp_replace({}, '\\\\x{{FFFF}}+', '#')"
    candidate = (
        f"transform(concat({numbers}, _addresses), c -> named_struct('start', c.start, 'end', c.end,"
        f" 'value', c.value, 'before', {plain.format('c.before')}, 'after', {plain.format('c.after')}))"
    )
    return docs.withColumn("candidate", F.expr(candidate)).drop("_numbers", "_addresses", "_masked")


def _with_located(docs: DataFrame, name: str, pattern: str, needs: str, text: str = "text") -> DataFrame:
    first, second, third = _located(pattern, needs, text)
    docs = docs.withColumns({k: F.expr(v) for k, v in first.items()})
    docs = docs.withColumns({k: F.expr(v) for k, v in second.items()})
    return docs.withColumn(name, F.expr(third)).drop("_found", "_gaps", "_lens")


def _with_masked(docs: DataFrame) -> DataFrame:
    """``docs`` with _masked: the text, of equal length, with base matches blotted out."""
    spans = ", ".join(
        f"transform({k}, x -> named_struct('start', x.start, 'end', x.end))" for k in KINDS
    )
    docs = docs.withColumn("_base", F.expr(f"sort_array(concat({spans}))")).withColumns(
        {
            "_chars": F.expr("if(size(_base) > 0, split(text, ''), null)"),
            "_ends": F.expr("transform(_base, s -> s.end)"),
        }
    )
    docs = docs.withColumn("_covered", F.expr(running("_ends", "0", "greatest(acc, v)")))
    pieces = (
        "zip_with(_base, _covered, (s, done) -> concat("
        "array_join(slice(_chars, done + 1, greatest(s.start - done, 0)), ''),"
        " repeat(decode(unhex('EFBFBF'), 'UTF-8'), greatest(s.end - greatest(s.start, done), 0))))"
    )
    rest = "array_join(slice(_chars, array_max(_ends) + 1, size(_chars)), '')"
    masked = f"if(size(_base) > 0, concat(array_join({pieces}, ''), {rest}), text)"
    return docs.withColumn("_masked", F.expr(masked)).drop("_base", "_chars", "_ends", "_covered")


_LAST = r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$"
_FIRST = r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)"


def _patterns() -> str:
    """Lexical patterns of a context: two words before, two after, and one on each side."""
    word = [
        f"lower(regexp_extract(before, {sql_text(_LAST)}, {i}))" for i in (1, 2)
    ] + [f"lower(regexp_extract(after, {sql_text(_FIRST)}, {i}))" for i in (1, 2)]
    return (
        f"filter(array(concat({word[0]}, ' ', {word[1]}, ' _'), concat('_ ', {word[2]}, ' ',"
        f" {word[3]}), concat({word[1]}, ' _ ', {word[2]})), p -> not (p rlike '^ |  | $'))"
    )


def _edges(found: DataFrame) -> DataFrame:
    """(pattern, value, kind): different values per pattern; kind is null for candidates."""
    sides = []
    for kind in (*KINDS, "candidate"):
        rows = found.select(F.explode(kind).alias("x")).select("x.value", "x.before", "x.after")
        named = F.lit(kind if kind in KINDS else None).cast("string").alias("kind")
        sides.append(rows.select(F.explode(F.expr(_patterns())).alias("pattern"), "value", named))
    return reduce(DataFrame.unionByName, sides).distinct()


def discovered(found: DataFrame, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """(value, kind, score): candidates accepted as instances of a kind.

    ``found`` is what ``base_spans`` returns. All edges take part. Sums per pattern and per
    value are partial before they are shuffled.
    """
    edges = staged(_edges(found), "edges")
    totals = edges.select("pattern", "value").distinct().groupBy("pattern").agg(
        F.count("*").alias("total")
    )
    seeds = edges.filter("kind is not null").select("value", "kind").distinct().withColumn(
        "score", F.lit(1.0)
    )
    pairs = edges.select("pattern", "value").distinct()
    plausible = " or ".join(f"(kind = '{k}' and {PLAUSIBLE[k]})" for k in KINDS)
    believed = seeds
    accepted = None
    for _ in range(settings.rounds):
        scored = (
            pairs.join(believed, "value")
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("mass"), F.count("*").alias("support"))
            .filter(F.col("support") >= settings.support)
            .join(totals, "pattern")
            .withColumn("confidence", F.col("mass") / (F.col("total") + settings.smoothing))
            .filter(F.col("confidence") >= settings.confidence)
        )
        accepted = staged(
            edges.filter("kind is null")
            .select("pattern", "value")
            .join(scored.select("pattern", "kind", "confidence"), "pattern")
            .filter(plausible)
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
            .filter(F.col("score") >= settings.accept)
            # One kind per value: the best score, then the kinds' order.
            .groupBy("value")
            .agg(F.max_by("kind", F.struct("score", -F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")))).alias("kind"), F.max("score").alias("score")),
            "accepted",
        )
        believed = seeds.unionByName(accepted.select("value", "kind", "score"))
    return accepted


def _key() -> list:
    return ["doc_id", F.xxhash64("text").alias("text_hash")]


def personal_spans(docs: DataFrame, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """Spans per row of ``docs``: doc_id, text_hash, base and spans.

    ``base`` and ``spans`` are arrays of (start, rank, end), sorted; rank is the place in
    KINDS; spans holds base and what the contexts add. Null and empty texts have none. Rows
    that are repeated get equal spans; a null doc_id stays null. Other columns are ignored.
    """
    found = staged(
        base_spans(docs.select("doc_id", "text")).select(*_key(), *KINDS, "candidate"), "found"
    )
    accepted = discovered(found, settings)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    added = (
        found.select("doc_id", "text_hash", F.explode("candidate").alias("c"))
        .select("doc_id", "text_hash", "c.value", "c.start", "c.end")
        .join(accepted, "value")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", rank.alias("rank"), "end")).alias("added"))
    )
    plain = [
        f"transform({kind}, x -> named_struct('start', x.start, 'rank', {i}, 'end', x.end))"
        for i, kind in enumerate(KINDS)
    ]
    base = found.withColumn("base", F.expr(f"sort_array(concat({', '.join(plain)}))")).select(
        "doc_id", "text_hash", "base"
    )
    same = base.doc_id.eqNullSafe(added.doc_id) & (base.text_hash == added.text_hash)
    return base.join(added, same, "left").select(
        base.doc_id,
        base.text_hash,
        "base",
        F.expr("if(added is null, base, sort_array(concat(base, added)))").alias("spans"),
    )


def span_text(spans: str) -> str:
    """kind:start:end of each span, comma-joined."""
    kinds = ", ".join(f"'{kind}'" for kind in KINDS)
    return (
        f"array_join(transform({spans}, s -> concat(array({kinds})[s.rank], ':', s.start, ':',"
        " s.end)), ',')"
    )


def redacted(docs: DataFrame, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets.

    Of overlapping spans the first gives the name and all are covered. Texts without spans
    stay as they are, null too. Columns and their order are kept.
    """
    changes = staged(
        personal_spans(docs, settings).filter("size(spans) > 0")
        .select("doc_id", "text_hash", "spans")
        .dropDuplicates(["doc_id", "text_hash"]),
        "spans",
    )
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *_key())
    if changes.count() <= BROADCAST_ROWS:
        changes = F.broadcast(changes)
    same = keyed.doc_id.eqNullSafe(changes.doc_id) & (keyed.text_hash == changes.text_hash)
    joined = keyed.join(changes, same, "left").select("row", "spans")
    marked = joined.withColumns(
        {
            "_chars": F.expr("if(spans is null, null, split(row.text, ''))"),
            "_ends": F.expr("transform(spans, s -> s.end)"),
        }
    ).withColumn("_covered", F.expr(running("_ends", "0", "greatest(acc, v)")))
    kinds = ", ".join(f"'<{kind.upper()}>'" for kind in KINDS)
    pieces = (
        "zip_with(spans, _covered, (s, done) -> if(s.start < done, '', concat("
        "array_join(slice(_chars, done + 1, s.start - done), ''),"
        f" array({kinds})[s.rank])))"
    )
    rest = "array_join(slice(_chars, array_max(_ends) + 1, size(_chars)), '')"
    text = F.expr(
        f"if(spans is null, row.text, concat(array_join({pieces}, ''), {rest}))"
    ).alias("text")
    return marked.select(
        *(text if name == "text" else F.col("row")[name].alias(name) for name in docs.columns)
    )


# Documents with spans that may be broadcast: a few spans each.
BROADCAST_ROWS = 500_000
