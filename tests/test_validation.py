"""Arguments are checked when they are given."""

import math

import pytest

from lexifacet import And, Near, Not, Or, Quorum, Search, Word
from lexifacet.operators.excerpts import ExcerptOptions, build_excerpts
from lexifacet.operators.updates import update_frame


@pytest.fixture(scope="module")
def s(test1):
    return Search.over(test1).match("wifi")


BAD = (ValueError, TypeError)


@pytest.mark.parametrize(
    "args",
    [("0", 20), (0, "20"), (-1, 20), (0, 0), (0, -1), (0, 20, -1), (0, 20, "5"), (0, 20, 5, -1), (0, 20, 5, "1"), (True, 20)],
)
def test_limits(s, args):
    with pytest.raises(BAD):
        s.limits(*args)


@pytest.mark.parametrize("text, mode", [(1, "all"), ("wifi", "nowhere"), ("wifi", 3), ("wifi", "extended")])
def test_match(s, text, mode):
    with pytest.raises(BAD):
        s.match(text, mode)


@pytest.mark.parametrize("tree", [1, None, "Wi-Fi", "two words", "", Not("wifi"), And(Not("a"), Not("b")), Or("a", Not("b"))])
def test_where(s, tree):
    with pytest.raises(BAD):
        s.where(tree)


def test_conditions():
    with pytest.raises(ValueError):
        Near("a b", 0)
    with pytest.raises(ValueError):
        Quorum("a b", 0)
    with pytest.raises(ValueError):
        And()


@pytest.mark.parametrize("args", [("nowhere",), (1,), ("expr",), ("expr", ""), ("expr", "lcs", ""), ("bm25", 1)])
def test_rank(s, args):
    with pytest.raises(BAD):
        s.rank(*args)


@pytest.mark.parametrize("args", [("nowhere",), (1,), ("attr_desc",), ("attr_asc", ""), ("expr", ""), ("extended",), ("time_segments", "created_at")])
def test_sort(s, args):
    with pytest.raises(BAD):
        s.sort_by(*args)


@pytest.mark.parametrize("weights", [1, "a", {1: 2}, {"name": "5"}, {"name": 1.5}, ["1"], [1.5], {"name": True}])
def test_field_weights(s, weights):
    with pytest.raises(BAD):
        s.field_weights(weights)


@pytest.mark.parametrize("weights", [1, [1], {1: 2}, {"test1": "5"}, {"test1": 1.5}])
def test_index_weights(s, weights):
    with pytest.raises(BAD):
        s.index_weights(weights)


@pytest.mark.parametrize("args", [("1", 2), (1, "2"), (2, 1), (1.5, 2)])
def test_id_range(s, args):
    with pytest.raises(BAD):
        s.id_range(*args)


@pytest.mark.parametrize(
    "args",
    [(1, [1]), ("group_id", "1"), ("group_id", ["1"]), ("group_id", [1.5]), ("group_id", None), ("group_id", [1], 1), ("nowhere", [1])],
)
def test_filter_values(s, args):
    with pytest.raises(BAD):
        s.filter_values(*args)


@pytest.mark.parametrize("args", [(1, 1, 2), ("group_id", "1", 2), ("group_id", 1, "2"), ("group_id", 2, 1), ("group_id", 1, 2, 0), ("group_id", 1.5, 2), ("nowhere", 1, 2)])
def test_filter_range(s, args):
    with pytest.raises(BAD):
        s.filter_range(*args)


@pytest.mark.parametrize("args", [(1, 1.0, 2.0), ("rating", "1", 2.0), ("rating", 1.0, "2"), ("rating", 2.0, 1.0), ("rating", 1.0, 2.0, 0)])
def test_filter_float_range(s, args):
    with pytest.raises(BAD):
        s.filter_float_range(*args)


@pytest.mark.parametrize("args", [(1, "lon", 0.5, 0.5), ("lat", 1, 0.5, 0.5), ("lat", "lon", "0.5", 0.5), ("lat", "lon", 0.5, "x")])
def test_geo_anchor(s, args):
    with pytest.raises(BAD):
        s.geo_anchor(*args)


@pytest.mark.parametrize(
    "args",
    [(1, "integer", {}), ("group_id", "nowhere", {}), ("group_id", 1, {}), ("group_id", "integer", [1]), ("group_id", "integer", {"1": 1}),
     ("group_id", "integer", {1: "1"}), ("group_id", "integer", {1: 1.5}), ("created_at", "timestamp", {1: "x"}), ("rating", "float", {1: "x"})],
)
def test_override(s, args):
    with pytest.raises(BAD):
        s.override(*args)


@pytest.mark.parametrize("columns", [(), (1,), ("group_id * 2",), ("*", "ln(rating)")])
def test_select(s, columns):
    with pytest.raises(BAD):
        s.select(*columns)


@pytest.mark.parametrize("args", [("", 0, 10), ("id", "0", 10), ("id", 0, "10"), ("id", -1, 10), ("id", 0, 0)])
def test_outer_select(s, args):
    with pytest.raises(BAD):
        s.outer_select(*args)


@pytest.mark.parametrize("args", [(1, "attr"), ("group_id", "nowhere"), ("group_id", 1), ("group_id", "attr", "")])
def test_group_by(s, args):
    with pytest.raises(BAD):
        s.group_by(*args)


def test_group_distinct_and_idf(s):
    for bad in (lambda: s.group_distinct(1), lambda: s.idf("nowhere"), lambda: Search.over(), lambda: Search.over("x")):
        with pytest.raises(BAD):
            bad()


@pytest.mark.parametrize(
    "args",
    [("group_id", {}), ([1], {}), (["group_id"], [1]), (["group_id"], {"1": [1]}), (["group_id"], {1: 1}), (["group_id"], {1: [1, 2]}),
     (["group_id"], {1: ["1"]}), (["group_id"], {1: [1]}, 1), (["tags"], {1: [1]}, True), (["tags"], {1: [["1"]]}, True)],
)
def test_update(spark, args):
    with pytest.raises(BAD):
        update_frame(spark, "id", *args)


@pytest.mark.parametrize(
    "options",
    [{"limit": "1"}, {"limit": -1}, {"around": 1.5}, {"before_match": 1}, {"chunk_separator": None}, {"html_strip_mode": "x"}, {"passage_boundary": "x"}, {"nowhere": 1}],
)
def test_excerpt_options(options):
    with pytest.raises(BAD):
        ExcerptOptions(**options)


def test_excerpt_words(spark):
    docs = spark.createDataFrame([(1, "a")], "id long, text string")
    for words in (1, "", "!?", Word("a")):
        with pytest.raises(BAD):
            build_excerpts(docs, "id", "text", words)


def test_a_builder_does_not_change(s):
    before = s
    s.filter_values("group_id", 1).limits(5, 5).group_by("group_id").geo_anchor("rating", "rating", 0.0, math.pi)
    assert s == before and not s.filters and s.group is None and s.offset == 0


def test_resets(s):
    full = s.filter_values("group_id", 1).geo_anchor("rating", "rating", 0.0, 1.0).group_by("group_id").group_distinct("rating")
    full = full.override("group_id", "integer", {1: 2}).outer_select("id", 0, 5).id_range(1, 2)
    assert full.reset_filters().filters == () and full.reset_filters().anchor is None
    assert full.reset_filters().ids == (1, 2)
    assert full.reset_group_by().group is None and full.reset_group_by().distinct is None
    assert full.reset_overrides().overrides == () and full.reset_outer_select().outer is None


def test_zero_limits_keep_earlier_values(s):
    t = s.limits(0, 10, 50, 7).limits(5, 10)
    assert (t.offset, t.limit, t.max_matches, t.cutoff) == (5, 10, 50, 7)
