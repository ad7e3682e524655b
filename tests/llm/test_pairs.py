import random
import re

import pytest
from pyspark.sql import functions as F

from stockloom.llm import components, decontaminate, partenum
from tests.llm.fixtures import awkward, clashing, documents, prose


def word_sets(rows, size):
    found = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
        grams = set(zip(*(words[i:] for i in range(size)), strict=False))
        found[doc_id] = grams if len(words) >= size else ({tuple(words)} if words else set())
    return found


def brute_components(sets, percent):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            common = len(sets[i] & sets[j])
            if i < j and common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}


def near_copies(count, words, edits, seed):
    choice = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(choice.randrange(edits + 1)):
            copy[choice.randrange(len(copy))] = f"edit{choice.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80), (1, 50)])
def test_components_equal_brute_force(spark, words, percent):
    texts = [prose(i, n) for i, n in enumerate((1, 2, 3, 4, 9, 10, 11, 12, 13, 40, 41, 300))]
    texts += near_copies(40, 120, 4, 50) + near_copies(25, 30, 2, 51) + near_copies(10, 700, 20, 52)
    texts += [texts[0].upper(), texts[-1], "", "  "]
    rows = list(enumerate(texts))
    docs = documents(spark, [(i, t, "en", "a", 0) for i, t in rows])
    found = partenum.jaccard_components(docs, words, percent).collect()
    sets = word_sets(rows, words)
    expected = brute_components(sets, percent)
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.component_id for r in found} == expected
    assert len(set(expected.values())) < len(texts) - 20


def test_awkward_rows_and_columns(spark):
    found = partenum.jaccard_components(clashing(documents(spark))).collect()
    assert len(found) == len(awkward())
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[7].component_id == 6 and by_id[1].component_id == 1
    assert [by_id[i].n_shingles for i in (2, 3, 4)] == [0, 0, 0]
    assert [r.component_id for r in found if r.doc_id is None] == [None, None]
    kept = partenum.one_per_group(clashing(documents(spark)), 5, 80)
    assert kept.columns == clashing(documents(spark)).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 2, 3, 4, 6, 8, 9, 10, None, None]


def test_empty_table(spark):
    empty = documents(spark, [])
    assert partenum.jaccard_components(empty).collect() == []
    assert partenum.one_per_group(empty).collect() == []


def test_chain_is_one_component(spark):
    edges = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components.components(edges).collect()
    assert {r.node for r in found} == set(range(1, 201))
    assert {r.component for r in found} == {1}


def test_decontamination_equals_brute_force(spark):
    items = [(i, prose(900 + i, n)) for i, n in enumerate((5, 6, 8, 12, 16, 17, 33, 60, 64, 65, 300))]
    items += [(50, "one"), (51, None), (52, ""), (53, "only four words here")]
    texts = []
    for i, (_, text) in enumerate(items[:11]):
        words = text.split()
        texts.append(prose(i, 3000) + " " + " ".join(words) + " " + prose(i + 100, 3000))
        texts.append(prose(i, 50) + " " + " ".join(words[: max(1, len(words) * 3 // 5)]))
        texts.append(" ".join(words).upper().replace(" ", ",\n"))
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, "One!"), (903, prose(7))]
    docs = documents(spark, [(i, t, "en", "a", 0) for i, t in rows])
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, table).collect()}

    def plain(text):
        return re.sub(r"[\x00-\x2f:-@\[-`{-\x7f]+", " ", text or "").lower()

    sets = word_sets([(i, plain(t)) for i, t in rows], 5)
    wanted = word_sets([(i, plain(t)) for i, t in items], 5)
    expected = {
        (d, i)
        for i, item in wanted.items()
        for d, own in sets.items()
        if item and 100 * len(item & own) >= 80 * len(item)
    }
    assert found == expected
    assert {(902, 50)} <= found and len(found) >= 22
    left = {r.doc_id for r in decontaminate.decontaminated(docs, table).collect()}
    assert left == {i for i, _ in rows} - {d for d, _ in found}


def test_decontamination_of_awkward_rows(spark):
    items = spark.createDataFrame([(1, prose(1)), (None, None)], "item_id bigint, text string")
    docs = clashing(documents(spark))
    found = decontaminate.matches(docs, items).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, 1), (1, 1)]
    assert decontaminate.decontaminated(docs, items).count() == len(awkward()) - 2
    assert decontaminate.matches(documents(spark, []), items).count() == 0
    assert decontaminate.matches(docs, items.limit(0)).count() == 0
