import hashlib

import public_tokenizers
import sentencepiece

import corpus_pipeline
from stockloom.llm import pii, sentencepiece_bpe
from tests.llm.fixtures import SCHEMA, prose
from tests.llm.test_pairs import brute_components, word_sets
from tests.llm.test_texts import base_pii, statistics


def passes(text):
    n, _, _, _, repeated = statistics(text)
    return n >= 50 and 100 * repeated <= 50 * n


def redact(text):
    out, done = [], 0
    for start, rank, end in base_pii(text):
        if start >= done:
            out += [text[done:start], f"<{pii.KINDS[rank].upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def test_pipeline_equals_brute_force(spark, tmp_path):
    item = prose(700, 30)
    rows = [(i, prose(i, 80), "en", "a", 0) for i in range(12)]
    rows += [(20, prose(3, 80), "en", "b", 0), (21, prose(4, 80) + " tail", None, None, None)]
    rows += [(30, f"{prose(50)} {item} {prose(51)}", "en", "a", 0), (31, "too short", "en", "a", 0)]
    rows += [(32, "a b c " * 40, "en", "a", 0), (33, None, None, None, None), (34, "", "en", "a", 0)]
    rows += [(40, f"{prose(60)} me@example.com {prose(61)} 4111111111111111", "en", "a", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    kept = [(r[0], r[1]) for r in rows if passes(r[1])]
    groups = brute_components(word_sets(kept, 5), 80)
    kept = [(i, t) for i, t in kept if groups[i] == i]
    wanted = word_sets([(1, item)], 5)[1]
    sets = word_sets(kept, 5)
    kept = [(i, t) for i, t in kept if 100 * len(wanted & sets[i]) < 80 * len(wanted)]
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(sentencepiece_bpe.MODEL)
    )
    assert set(found) == {i for i, _ in kept} == {*range(12), 40}
    for doc_id, text in kept:
        row, clean = found[doc_id], redact(text)
        assert row.text == clean and row.token_ids == library.encode(clean)
        assert row.n_tokens == len(row.token_ids)
        again = library.decode(row.token_ids).encode()
        assert row.decoded_sha256 == hashlib.sha256(again).hexdigest()
        assert (row.lang, row.source) == ("en", "a")
    assert "<EMAIL>" in found[40].text and "<CARD>" in found[40].text


def test_pipeline_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules"
