import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.llm import spelling_variants
from tests.llm.fixtures import awkward, clashing, documents

LETTERS = "abcdeé÷"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    same = len(os.path.commonprefix([a, b]))
    return a[same + 1 :] == b[same + (len(a) == len(b)) :]


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out, forms = {}, {}
    for w, n in words.items():
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
        out[w] = [n, len(near)]
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, *out[w], words.get(forms[w]))
    return out


def rows_of(found):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}


def edited(choice, word):
    place = choice.randrange(len(word))
    kind = choice.randrange(3)
    if kind == 0:
        return word[:place] + word[place + 1 :]
    return word[:place] + choice.choice(LETTERS) + word[place + (kind == 1) :]


def corpus(seed):
    """Bases with variants, variants of variants and very different frequencies."""
    choice = random.Random(seed)
    bases = ["".join(choice.choice(LETTERS) for _ in range(choice.randrange(7, 12))) for _ in range(30)]
    bases += ["aaaaaaaa", "aaaaaaaaa", "abababab", "bababab", "x" * 3000, "x" * 2999 + "y"]
    bases += ["ab" * 32, "ab" * 32 + "a", "ab" * 33, "ab" * 31 + "é"]
    words = ["zyxwvutsr"] * 600 + ["zyxwvuts"] * 40 + ["zyxwvut"] * 3
    for base in bases:
        words += [base] * choice.choice((2, 30, 400))
        for _ in range(3):
            variant = edited(choice, base)
            words += [variant] * choice.choice((1, 2, 3, 40)) + [edited(choice, variant).upper()] * 2
    choice.shuffle(words)
    return [(i, " ".join(words[i::50]) + "." * i) for i in range(50)]


@pytest.mark.parametrize("fewest", [2, 4, 9])
def test_variants_equal_brute_force(spark, monkeypatch, fewest):
    monkeypatch.setattr(spelling_variants, "FEWEST_SYMBOLS", fewest)
    rows = corpus(fewest)
    rows += [(None, rows[0][1]), (7, rows[7][1]), (900, None), (901, ""), (902, "short words only")]
    docs = documents(spark, [(i, t, "en", "a", 0) for i, t in rows]).repartition(5)
    found = spelling_variants.variants(clashing(docs.withColumn("word", F.lit(1)))).collect()
    wanted = brute(rows)
    assert rows_of(found) == wanted and len(found) == len(wanted)
    assert any(form and root != form for form, root, *_ in wanted.values())


def test_awkward_and_empty_tables(spark):
    found = spelling_variants.variants(documents(spark)).collect()
    assert rows_of(found) == brute([(r[0], r[1]) for r in awkward()])
    assert spelling_variants.variants(documents(spark, [])).collect() == []


def test_words_of_any_length(spark):
    text = " ".join(["a" * 200_000] * 30 + ["a" * 199_999] * 2 + ["b" + "a" * 199_999] * 3)
    found = rows_of(spelling_variants.variants(documents(spark, [(5, text, "en", "a", 0)])).collect())
    wanted = brute([(5, text)])
    assert {(k[0], len(k)) for k in found} == {(k[0], len(k)) for k in wanted}
    assert found == wanted


def test_neighbourhood_is_full_and_without_repeats():
    draw = np.random.default_rng(2)
    for symbols, length in ((2, 1), (3, 7), (5, 9)):
        digits = draw.integers(1, symbols + 1, (40, length)).astype(np.uint64)
        rows, keys = spelling_variants.neighbour_keys(digits, symbols)
        for row in range(len(digits)):
            word = digits[row].tolist()
            around = {tuple(word)}
            around |= {tuple(word[:i] + word[i + 1 :]) for i in range(length)}
            around |= {
                tuple(word[:i] + [s] + word[i + 1 :])
                for i in range(length) for s in range(1, symbols + 1)
            }
            wanted = {
                int(spelling_variants.reduced_keys(np.array([w], dtype=np.uint64).reshape(1, -1))[0])
                for w in around if w
            }
            own = keys[rows == row].tolist()
            assert len(own) == len(set(own)) == len(around)
            assert wanted <= set(own)


def test_symbols_grow_slowly():
    assert spelling_variants.symbols_for(0) == spelling_variants.symbols_for(10**6) == 4
    assert spelling_variants.symbols_for(10**8) == 5 and spelling_variants.symbols_for(10**12) == 12
