"""Rows with NULL votes or class are reported by the vote checks, not lost."""

from tagloom.operators import quality


def test_null_votes_are_violations(spark):
    rows = [
        (1, 3, 0, 3, 0, 0),  # fine
        (2, 3, 0, None, 1, 2),  # a NULL vote
        (3, 3, None, 3, 0, 0),  # a NULL class
        (4, 2, 0, 1, 1, 0),  # fine: ties go to the first class
        (5, None, 0, 3, 0, 0),  # NULL panel size
    ]
    df = spark.createDataFrame(rows, "tweet_id long, annotator_count int, class_id int, hate_votes int, offensive_votes int, neither_votes int")
    got = {r["tweet_id"]: (r["sum_ok"], r["class_ok"]) for r in quality.vote_violations(df).collect()}
    assert got == {2: (False, False), 3: (True, False), 5: (False, True)}
