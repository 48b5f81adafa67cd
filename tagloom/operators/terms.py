"""Token vocabularies, top terms and TF-IDF weights.

Corpus statistics need only one shuffle keyed by term: counts are combined inside each map
task, so a term found in every text costs one partial row per task. Per-text weights never
shuffle text; the bounded vocabulary travels to the tasks instead.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.arrays import pad_or_cut
from tagloom.functions.text import clean_tokens
from tagloom.operators.ranking import top_overall, top_per_group

# Stop words of the exploratory report.
REPORT_STOP_WORDS = "the a an and or to of in is it for on with you that this be are i my we so".split()

# Spark's default English stop words, as they read after text cleaning.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
ll d re ve m let cannot could ought would isn aren wasn weren hasn haven hadn doesn didn won
wouldn shan shouldn couldn mustn
""".split()

PAD_ID, OOV_ID = 0, 1


def top_tokens(df, clean="clean_text", group="class_id", k=12, stop_words=REPORT_STOP_WORDS, min_length=3):
    """Most frequent words per class; ties go to the alphabetically first word."""
    words = df.select(group, F.explode(F.split(clean, " ")).alias("token"))
    words = words.where((F.length("token") >= min_length) & ~F.col("token").isin(*stop_words))
    counts = words.groupBy(group, "token").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, [group], [F.desc("n"), F.asc("token")], k)


def build_vocabulary(df, clean="clean_text", max_size=20_000, min_freq=1):
    """Most frequent words with ids from 2; 0 pads and 1 stands for unknown words."""
    words = df.select(F.explode(clean_tokens(clean)).alias("token"))
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    top = top_overall(counts, [F.desc("freq"), F.asc("token")], max_size)
    return top.where(F.col("freq") >= min_freq).select(
        "token", (F.col("rank") + 1).cast("int").alias("token_id"), "freq"
    )


def max_token_length(df, clean="clean_text"):
    return df.agg(F.max(F.size(clean_tokens(clean))).alias("max_len"))


def encode(df, vocabulary, max_len=None, key="tweet_id", clean="clean_text"):
    """Token ids in text order, unknown words as 1; cut or padded if a ``max_len`` is given.

    The vocabulary is bounded by its maximum size, so every task holds it and looks the words
    of a whole batch up at once; no row moves.
    """
    known = vocabulary.select("token", "token_id").collect()
    words = pa.array([r["token"] for r in known], pa.string())
    # Behind the last place: the id of a word that is not found.
    numbers = np.array([*(r["token_id"] for r in known), OOV_ID], dtype=np.int32)
    tokens = clean_tokens(clean) if max_len is None else F.slice(clean_tokens(clean), 1, max_len)

    def look_up(batches):
        for batch in batches:
            lists = batch.column("tokens")
            places = pc.fill_null(pc.index_in(lists.flatten(), value_set=words), len(words))
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers[places.to_numpy()]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), ids], names=["key", "ids"])

    kind = df.schema[key].dataType.simpleString()
    encoded = df.select(F.col(key).alias("key"), tokens.alias("tokens")).mapInArrow(look_up, f"key {kind}, ids array<int>")
    ids = F.col("ids") if max_len is None else pad_or_cut("ids", max_len, PAD_ID)
    return encoded.select(F.col("key").alias(key), ids.alias("ids"))


def embedding_matrix(vocabulary, vectors, size):
    """Vocabulary with its word vectors (word, vector); words without one get zeros and ``hit = false``."""
    from pyspark.ml.functions import vector_to_array

    known = vectors.select(F.col("word").alias("token"), vector_to_array("vector").alias("vector"))
    zeros = F.array_repeat(F.lit(0.0), size)
    return vocabulary.join(known, "token", "left").select(
        "token",
        "token_id",
        F.col("vector").isNotNull().alias("hit"),
        F.coalesce("vector", zeros).alias("vector"),
    )


# --- TF-IDF -------------------------------------------------------------------------------


def with_terms(df, clean="clean_text", stop_words=ENGLISH_STOP_WORDS, out="terms"):
    """Add the array of word and bigram occurrences of a cleaned text."""
    words = F.filter(
        F.split(clean, " "), lambda w: (F.length(w) >= 2) & ~w.isin(*stop_words)
    )
    bigrams = F.zip_with(
        F.slice(F.col("_words"), 1, F.greatest(F.size("_words") - 1, F.lit(0))),
        F.slice(F.col("_words"), 2, F.greatest(F.size("_words") - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return (
        df.withColumn("_words", words).withColumn(out, F.concat("_words", bigrams)).drop("_words")
    )


def term_statistics(with_term_arrays, terms="terms"):
    """Total and document frequency of every term, in one pass and one shuffle.

    Every Arrow batch of texts becomes one row for each distinct term, so what is hashed and
    shuffled is distinct terms of batches and not occurrences.
    """

    def count(batches):
        for batch in batches:
            lists = batch.column("terms")
            found = pc.dictionary_encode(lists.flatten(), null_encoding="encode")
            if not len(found):
                continue
            words, codes = found.dictionary, found.indices.to_numpy()
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            keys = np.repeat(np.arange(len(lengths)), lengths) * len(words) + codes
            keys.sort()
            first = np.ones(len(keys), dtype=bool)  # first occurrence of a term in its text
            np.not_equal(keys[1:], keys[:-1], out=first[1:])
            tf = np.bincount(codes, minlength=len(words))
            df = np.bincount(keys[first] % len(words), minlength=len(words))
            yield pa.RecordBatch.from_arrays([words, pa.array(tf), pa.array(df)], names=["term", "tf", "df"])

    partial = with_term_arrays.select(F.col(terms).alias("terms")).mapInArrow(count, "term string, tf long, df long")
    return partial.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def select_terms(statistics, min_df=5, max_features=5000):
    """The terms in enough texts with the highest total frequency, numbered alphabetically."""
    kept = (
        statistics.where(F.col("df") >= min_df)
        .orderBy(F.desc("tf"), F.asc("term"))
        .limit(max_features)
    )
    return top_overall(kept, [F.asc("term")], max_features, out="term_no").withColumn(
        "term_no", (F.col("term_no") - 1).cast("int")
    )


def smooth_idf(df_column, n_docs):
    return F.log((n_docs + F.lit(1.0)) / (F.col(df_column) + 1)) + 1.0


@dataclass
class TfIdf:
    """Fitted TF-IDF space: alphabetical terms and their inverse document frequencies."""

    terms: list
    idf: list
    stop_words: tuple = tuple(ENGLISH_STOP_WORDS)

    @classmethod
    def fit(cls, df, clean="clean_text", min_df=5, max_features=5000, stop_words=ENGLISH_STOP_WORDS):
        vocabulary = select_terms(
            term_statistics(with_terms(df, clean, stop_words)), min_df, max_features
        )
        n_docs = F.lit(df.count())
        # At most max_features rows reach the driver: they are the model itself.
        rows = vocabulary.select("term_no", "term", smooth_idf("df", n_docs).alias("idf")).collect()
        rows.sort(key=lambda r: r["term_no"])
        return cls([r["term"] for r in rows], [float(r["idf"]) for r in rows], tuple(stop_words))

    def transform(self, df, clean="clean_text", out="tfidf", drop=()):
        """Add the unit-length sparse vector of (1 + ln tf) * idf weights; no shuffle.

        Columns named in ``drop`` (such as the texts) are left behind before the Arrow step.
        """
        counted = CountVectorizerModel.from_vocabulary(
            self.terms, inputCol="_terms", outputCol="_counts"
        ).transform(with_terms(df, clean, self.stop_words, "_terms")).drop("_terms", *drop)
        weighted = _map_sparse_values(counted, "_counts", "_tf", lambda v: F.log(v) + 1.0)
        weighted = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_w"
        ).transform(weighted)
        return Normalizer(p=2.0, inputCol="_w", outputCol=out).transform(weighted).drop(
            "_counts", "_tf", "_w"
        )

    def weights(self, df, key="tweet_id", clean="clean_text"):
        """The same weights as rows (key, term, weight)."""
        vectors = F.unwrap_udt("_v")
        pairs = F.arrays_zip(vectors["indices"].alias("i"), vectors["values"].alias("w"))
        names = pa.table({"i": pa.array(range(len(self.terms)), pa.int32()), "term": self.terms})
        names = df.sparkSession.createDataFrame(names)  # bounded by the vocabulary size
        return (
            self.transform(df.select(key, clean), clean, "_v", drop=[clean])
            .select(key, F.inline(pairs).alias("i", "weight"))
            .join(F.broadcast(names), "i")
            .select(key, "term", "weight")
        )


def _map_sparse_values(df, vector, out, fn):
    """Apply a Column function to the stored values of a sparse vector column.

    The new struct only needs its vector type back; handing the Arrow batches through
    unchanged does that without touching a row in Python.
    """
    parts = F.unwrap_udt(vector)
    plain = df.withColumn(
        out,
        F.struct(
            parts["type"].alias("type"),
            parts["size"].alias("size"),
            parts["indices"].alias("indices"),
            F.transform(parts["values"], fn).alias("values"),
        ),
    ).drop(vector)
    schema = T.StructType(
        [T.StructField(f.name, VectorUDT() if f.name == out else f.dataType) for f in plain.schema]
    )
    return plain.mapInArrow(lambda batches: batches, schema)
