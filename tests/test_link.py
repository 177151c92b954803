from termloom.operators import link


def test_dictionary_overlaps_are_resolved_greedily(spark):
    """A > B > C, where A overlaps B and B overlaps C but not A: A and C stand."""
    entries = spark.createDataFrame([("kolavi tamuro sepidine", "", "A", None), ("sepidine govulaxate", "", "B", None), ("govulaxate rim", "", "C", None)], "term string, preferred string, code string, semtypes array<string>")
    queries = spark.createDataFrame([("q", "kolavi tamuro sepidine govulaxate rim"), ("r", "sepidine govulaxate rim"), (None, "govulaxate rim"), ("s", "govulaxate rim")], "id string, text string")
    got = sorted((r["id"], r["code"]) for r in link.DictionaryLinker(entries, threshold=0.9).link(queries).collect())
    assert got == [("q", "A"), ("q", "C"), ("r", "B"), ("s", "C")]
