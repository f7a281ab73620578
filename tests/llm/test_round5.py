"""What the driver keeps of plans in the rounds of components."""

from acopio.llm import banding, components


def test_component_rounds_hold_no_step_twice(spark, monkeypatch):
    """Each plan of a round reads written edges and has four shuffles at most: the first half of a round is not planned again in the second."""
    shuffles = []
    kept = components.stage

    def stage(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles.append(plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning"))
        return kept(df, label)

    monkeypatch.setattr(components, "stage", stage)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r[0]: r[1] for r in components.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert len(shuffles) > 3 and max(shuffles) <= 4


def test_components_are_found_again_from_their_ties(spark, monkeypatch):
    """Known components go on as one edge per node, so that joining them takes one round less than their first edges."""
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    found = components.connected_components(path)
    ties = banding._ties(found)
    assert sorted((r["a"], r["b"]) for r in ties.collect()) == [(i, 0) for i in range(1, 41)]
    labels = []
    kept = components.stage
    monkeypatch.setattr(components, "stage", lambda df, label: (labels.append(label), kept(df, label))[1])
    again = {r[0]: r[1] for r in components.connected_components(ties).collect()}
    assert again == {i: 0 for i in range(41)} and labels.count("large-star") == 1
