from hearthstream.llm.components import components


def test_paths_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
