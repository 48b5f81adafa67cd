"""Annotated-text tables derived from the documents, labels, events and chat tables."""

from pyspark.sql import functions as F

from tagloom.sources.raw import normalise


def table(spark, root, name):
    return spark.read.parquet(f"{root}/{name}.parquet")


def documents(spark, root, spread=None):
    """Ids and texts; ``spread`` deals rows of few large files out to so many tasks."""
    df = table(spark, root, "documents").select("doc_id", "text")
    return df.repartition(spread, "doc_id") if spread else df


def pages(spark, root, spread=None):
    df = table(spark, root, "pages").select("page_id", "url", "html")
    return df.repartition(spread, "page_id") if spread else df


def raw_items(spark, root):
    """Labelled documents in the flat shape of the annotated CSV.

    Class: toxic texts 0, low quality 1, the rest 2. The panel size and its minority votes
    follow from the id, so that votes sum to the panel and the class is their maximum.
    """
    joined = table(spark, root, "labels").join(documents(spark, root), "doc_id")
    class_id = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    panel = F.when(F.col("doc_id") % 20 == 0, 6).when(F.col("doc_id") % 33 == 0, 9).otherwise(3)
    minority = F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)

    def votes(k):
        return (
            F.when(class_id == k, panel - minority)
            .when((class_id + 1) % 3 == k, minority)
            .otherwise(0)
        )

    return joined.select(
        F.col("doc_id").alias("tweet_id"),
        panel.alias("count"),
        votes(0).alias("hate_speech"),
        votes(1).alias("offensive_language"),
        votes(2).alias("neither"),
        class_id.alias("class"),
        F.col("text").alias("tweet"),
    )


def tables(spark, root):
    return normalise(raw_items(spark, root))


def panel_votes(spark, root):
    """Long-form votes: every event is a vote by type on the user it belongs to."""
    kind = F.col("event_type")
    return (
        table(spark, root, "events")
        .groupBy(F.col("user_id").alias("tweet_id"))
        .agg(
            F.count_if(kind == "error").cast("int").alias("hate_votes"),
            F.count_if(kind == "click").cast("int").alias("offensive_votes"),
            F.count_if(~kind.isin("error", "click")).cast("int").alias("neither_votes"),
            F.count(F.lit(1)).cast("int").alias("annotator_count"),
        )
    )


def scored_items(spark, root):
    """Items with probabilities computed from the id, for exact checks of every metric."""
    raw = [((F.col("tweet_id") * (37 + k * 10) + k * 13) % 101) + 1 for k in range(3)]
    total = (raw[0] + raw[1] + raw[2]).cast("double")
    return tables(spark, root)["tweets"].select(
        "tweet_id",
        F.col("class_id").alias("true_class_id"),
        *(
            (r.cast("double") / total).alias(name)
            for r, name in zip(raw, ("prob_hate", "prob_offensive", "prob_neither"))
        ),
    )


def conversation_turns(spark, root):
    """Chat turns as a second text source; the key is the pair of conversation and turn, as text."""
    return table(spark, root, "conversations").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("tweet_id"), "conv_id", "turn", "role", "text"
    )
