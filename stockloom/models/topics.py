"""Recurring themes in review texts."""

from __future__ import annotations

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.session import materialize

# Far above what the share of documents lets through: the vocabulary is not cut.
MOST_WORDS = 1 << 28
# Fixed value: text whose counts of words one task reads in an iteration, some 25 MB.
CHARACTERS_PER_TASK = 40_000_000


def topic_terms(
    reviews: DataFrame,
    text: str = "review_comment_message",
    topics: int = 5,
    terms: int = 10,
    min_documents: float = 0.0005,
    language: str = "english",
    iterations: int = 10,
    seed: int = 42,
) -> DataFrame:
    """The strongest ``terms`` words of each topic of an LDA model over whole texts.

    Words are letters only, three or more, without the stop words of
    ``language``. The vocabulary holds every word that at least a share of
    ``min_documents`` of the texts has (a number of texts from 1 on), which bounds it by
    the texts' mean number of words over that share. Every iteration goes over all texts, in
    more tasks than the files have parts where these hold too much text for one task.
    """
    words = RegexTokenizer(
        inputCol=text, outputCol="_words", pattern=r"\p{L}+", gaps=False, minTokenLength=3
    ).transform(reviews.where(F.col(text).isNotNull()))
    stop_words = StopWordsRemover.loadDefaultStopWords(language)
    kept = StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=stop_words)
    kept_words = kept.transform(words).select("_kept")
    texts, characters = reviews.agg(F.count(text), F.coalesce(F.sum(F.length(text)), F.lit(0))).first()
    # With a share, Spark would count the texts itself and cache all their words for it.
    least = min_documents if min_documents >= 1 else max(1.0, min_documents * texts)
    counter = CountVectorizer(
        inputCol="_kept", outputCol="features", vocabSize=MOST_WORDS, minDF=least
    ).fit(kept_words)
    counted = counter.transform(kept_words).select("features")
    tasks = -(-characters // CHARACTERS_PER_TASK)
    if tasks > counted.rdd.getNumPartitions():
        counted = counted.repartition(tasks)
    # Read once per iteration, so it is stored once.
    counted = materialize(counted)
    lda = LDA(k=topics, maxIter=iterations, seed=seed, optimizer="online", subsamplingRate=1.0)
    model = lda.fit(counted)
    described = model.describeTopics(terms)
    ranked = described.select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "pair")
    )
    spelled = reviews.sparkSession.createDataFrame(
        list(enumerate(counter.vocabulary)), "term_index int, term string"
    )
    return (
        ranked.select(
            "topic",
            (F.col("rank") + 1).alias("rank"),
            F.col("pair.termIndices").alias("term_index"),
            F.col("pair.termWeights").alias("weight"),
        )
        .join(spelled, "term_index")
        .select("topic", "rank", "term", "weight")
        .orderBy("topic", "rank")
    )
