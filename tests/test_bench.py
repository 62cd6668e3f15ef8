import bench


def test_slow_queries_are_in_the_headline():
    assert {"h09_hierarchy", "k06_schema_diff", "k07_shape_diff"} <= set(bench.HEADLINE)
