"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are dealt by hash to a few symbols. Two words one edit apart become reduced words
that are equal or one edit apart. Each word makes the full neighbourhood of its reduced
word: itself, every replaced symbol and every deletion; an insertion is a deletion seen
from the longer word, so such pairs are made there and turned round. Reduced words are
64-bit hashes, computed for all words of one length at a time. The neighbourhoods meet the
reduced vocabulary in one join by hash, whose condition compares the words themselves, so
only true pairs become rows. Words of more than CARRIED letters meet by their hash first.

The more symbols, the larger the neighbourhoods and the fewer words share a reduced one;
their number grows with the logarithm of the vocabulary. Pairs are the same for any number.

Defined cases: a null text has no words, a null doc_id is written as nothing before the
colon. Repeated rows count again. Words have no largest length. Without words there are
no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import matches, staged
from stockloom.llm.words import mix

# Code points of the shortest word, occurrences of the rarest.
SHORTEST, RAREST = 7, 2
# How many times as frequent as a word its form is.
RATIO = 10
FEWEST_SYMBOLS = 4
# About as many words as there are reduced words of so many symbols.
REDUCED_LENGTH = 11
# Letters of the longest word that its neighbours carry.
CARRIED = 64
# Neighbours made at a time.
ROWS = 400_000

# Odd, so that powers never vanish modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def corpus_words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts with some letters lost, as ``vocabulary`` counts them.

    A run of letters loses the code point h % length if 31 divides h, the crc32 of
    "doc_id:run". Runs too short to become a word are passed over by the pattern.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(matches("text", "[A-Za-z\\u00C0-\\u00FF]{%d,}" % SHORTEST)).alias("run"),
    ).select("id", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    place = "cast(h % length(run) as int)"
    shorter = F.expr(f"concat(left(run, {place}), substr(run, {place} + 2))")
    word = F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words that are long and frequent enough."""
    return corpus_words(docs).filter(f"length(word) >= {SHORTEST} and n >= {RAREST}")


def symbols_for(words: int) -> int:
    """Symbols of the reduced alphabet for a vocabulary of so many words."""
    return max(FEWEST_SYMBOLS, round(words ** (1 / REDUCED_LENGTH)))


def _powers(count: int) -> np.ndarray:
    powers = np.full(count, _BASE)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def reduced(letters: np.ndarray, symbols: int) -> np.ndarray:
    """Letters, as code points, dealt to symbols 1 to ``symbols``."""
    return (mix(letters.astype(np.uint64)) % np.uint64(symbols)) + np.uint64(1)


def reduced_keys(digits: np.ndarray) -> np.ndarray:
    """Hashes of reduced words, one per row."""
    length = digits.shape[1]
    sums = (digits * _powers(length)).sum(axis=1, dtype=np.uint64)
    return mix(sums + mix(np.full(1, length, dtype=np.uint64)))


def neighbour_keys(digits: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the reduced words themselves, their replacements and deletions.

    No row has a hash twice: of a run of equal symbols only the last is deleted.
    """
    count, length = digits.shape
    powers = _powers(length)
    terms = digits * powers
    sums = terms.sum(axis=1, dtype=np.uint64)
    same, shorter = mix(np.array([length, length - 1], dtype=np.uint64))
    # Replacement: the sum changes by the difference of the symbols at one place.
    steps = np.arange(1, symbols, dtype=np.uint64)
    turned = (digits[:, :, None] - np.uint64(1) + steps) % np.uint64(symbols) + np.uint64(1)
    moved = sums[:, None, None] + (turned - digits[:, :, None]) * powers[None, :, None]
    # Deletion: what comes before the place, and what comes after moved down by one power.
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    low = np.concatenate([np.zeros((count, 1), np.uint64), digits[:, 1:] * powers[:-1]], axis=1)
    total = low.sum(axis=1, dtype=np.uint64)
    after = total[:, None] - np.cumsum(low, axis=1, dtype=np.uint64)
    last = np.ones((count, length), dtype=bool)
    last[:, :-1] = digits[:, 1:] != digits[:, :-1]
    rows = np.arange(count)
    deleted_rows, places = np.nonzero(last)
    return (
        np.concatenate([rows, np.repeat(rows, length * (symbols - 1)), deleted_rows]),
        np.concatenate(
            [
                mix(sums + same),
                mix(moved.reshape(count, -1) + same).ravel(),
                mix((before + after)[deleted_rows, places] + shorter),
            ]
        ),
    )


def _by_length(words: list[str], cost: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, code points) of words of equal length, about ROWS / ``cost`` letters a time."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    first = 0
    while first < len(order):
        length = int(lengths[order[first]])
        most = max(1, ROWS // (length * cost))
        last = int(np.searchsorted(lengths[order], length, side="right"))
        at = order[first : min(last, first + most)]
        text = "".join(words[i] for i in at.tolist()).encode("utf-32-le")
        yield at, np.frombuffer(text, dtype=np.uint32).reshape(len(at), length)
        first += len(at)


def _keyed(words: DataFrame, symbols: int, near: bool, carried: str) -> DataFrame:
    """The hash of each reduced word, or a row for each hash in its neighbourhood.

    Rows have key, n and the column ``carried``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.select([carried, "n"])
            for at, letters in _by_length(batch.column("word").to_pylist(), symbols if near else 1):
                digits = reduced(letters, symbols)
                if near:
                    rows, keys = neighbour_keys(digits, symbols)
                else:
                    rows, keys = np.arange(len(at)), reduced_keys(digits)
                chosen = own.take(pa.array(at[rows]))
                yield pa.record_batch([pa.array(keys.view(np.int64)), *chosen.columns], names)

    names = ["key", carried, "n"]
    kind = dict(words.dtypes)[carried]
    columns = list(dict.fromkeys(["word", carried, "n"]))
    return words.select(*columns).mapInArrow(run, f"key bigint, {carried} {kind}, n bigint")


def _met(words: DataFrame, others: DataFrame, symbols: int, carried: str) -> DataFrame:
    """(a, a_n, b, b_n): what is carried by words of ``others`` around those of ``words``."""
    around = _keyed(words, symbols, True, carried).toDF("key", "a", "a_n")
    return around.join(_keyed(others, symbols, False, carried).toDF("key", "b", "b_n"), "key")


def _one_edit_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose ``b``, no longer than ``a``, is one edit away; linear in the letters."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            same = len(commonprefix([a, b]))
            keep.append(a != b and a[same + 1 :] == b[same + (len(a) == len(b)) :])
        yield batch.filter(pa.array(keep, pa.bool_()))


def near_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """(word, near, near_n): both orders of all words of ``words`` (word, n) one edit apart.

    Each row around a word carries the word, or its hash if it is longer than CARRIED
    letters; so long words are compared after the join, where few pairs are left.
    """
    wide = words.withColumn("id", F.xxhash64("word"))
    short = wide.filter(f"length(word) <= {CARRIED}")
    same = "a <> b and length(b) <= length(a) and levenshtein(a, b, 1) = 1"
    met = _met(short, short, symbols, "word").filter(same)
    by_id = _met(
        wide.filter(f"length(word) > {CARRIED}"),
        wide.filter(f"length(word) >= {CARRIED}"),
        symbols,
        "id",
    )
    for side in "ab":
        own = wide.filter(f"length(word) >= {CARRIED}").select(
            F.col("id").alias(side), F.col("word").alias(f"{side}_word")
        )
        by_id = by_id.filter("a <> b").join(own, side)
    pair = "a string, a_n bigint, b string, b_n bigint"
    by_id = by_id.selectExpr("a_word as a", "a_n", "b_word as b", "b_n")
    by_id = by_id.filter("length(b) <= length(a)").mapInArrow(_one_edit_apart, pair).distinct()
    met = met.select("a", "a_n", "b", "b_n").unionByName(by_id)
    one_way = "struct(a as word, b as near, b_n as near_n)"
    other_way = "struct(b as word, a as near, a_n as near_n)"
    # Words of equal length meet in both orders by themselves.
    ways = f"if(length(a) = length(b), array({one_way}), array({one_way}, {other_way}))"
    return met.select(F.explode(F.expr(ways)).alias("p")).select("p.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms, by doubling the steps.

    A form is RATIO times as frequent as its word, so chains are short and have no circle.
    """
    chains = staged(forms.select("word", F.col("form").alias("root")), "chains")
    while True:
        further = chains.toDF("root", "beyond")
        longer = chains.join(further, "root", "left")
        moved = staged(longer.select("word", "root", "beyond"), "chains")
        if moved.filter("beyond is not null").isEmpty():
            return moved.select("word", "root")
        chains = moved.select("word", F.coalesce("beyond", "root").alias("root"))


def _best(pairs: DataFrame) -> Column:
    """The near word of largest number, the smallest of those by code points."""
    return F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")


def variants(docs: DataFrame) -> DataFrame:
    """Each word of ``docs`` (doc_id, text) with its form and root.

    Columns: word; n, its occurrences; n_near, words one edit apart; form, the most
    frequent of these if RATIO times as frequent, with form_n; root, where forms lead to.
    """
    words = staged(vocabulary(docs), "vocabulary")
    pairs = near_pairs(words, symbols_for(words.count()))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), _best(pairs))
    judged = words.join(near, "word", "left").selectExpr(
        "word",
        "n",
        "coalesce(n_near, 0L) as n_near",
        f"if(-best.less >= {RATIO} * n, best.near, null) as form",
        f"if(-best.less >= {RATIO} * n, -best.less, null) as form_n",
    )
    judged = staged(judged, "forms")
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
