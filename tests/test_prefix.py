"""Running totals against brute force, with tiny blocks so that every level is used."""

from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewright.plans.prefix import dense_keys, later_in_group, rank_in_group, sum_before

quick = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
pairs = st.lists(
    st.tuples(st.integers(0, 2), st.integers(-(2**40), 2**40)), unique=True, min_size=1, max_size=40
)


@quick
@given(data=pairs, bits=st.sampled_from([4, 20, 40]))
def test_sum_before(spark, data, bits):
    df = spark.createDataFrame([(g, k, k % 7) for g, k in data], "g int, k long, w long")
    got = {(r.g, r.k): r.s for r in sum_before(df, ["g"], "k", "w", "s", bits=bits).collect()}
    want = {(g, k): sum(k2 % 7 for g2, k2 in data if g2 == g and k2 < k) for g, k in data}
    assert got == want


@quick
@given(keys=st.lists(st.integers(-(2**62), 2**62), unique=True, min_size=1, max_size=40))
def test_dense_keys(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.id for r in dense_keys(df, "k", "id", start=5).collect()}
    assert got == {k: 5 + i for i, k in enumerate(sorted(keys))}


@quick
@given(
    data=st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-500, 500))),
        min_size=1,
        max_size=40,
    )
)
def test_rank_counts_higher_scores(spark, data):
    numbered = [(i, g, None if s is None else Decimal(s) / 100) for i, (g, s) in enumerate(data)]
    df = spark.createDataFrame(numbered, "i int, g string, s decimal(10,2)")

    def higher(g, s):
        return sum(g2 == g and s2 is not None and s2 > s for _, g2, s2 in numbered)

    want = {i: 1 if g is None or s is None else 1 + higher(g, s) for i, g, s in numbered}
    assert {r.i: r.r for r in rank_in_group(df, "g", "s", "r").collect()} == want


def test_hot_group_keeps_all_rows(spark):
    """A group with most rows: nothing lost, positions right."""
    df = spark.range(60000).selectExpr("id", "if(id % 3 < 2, 0, id % 50) AS g")
    got = later_in_group(df, ["g"], "id", "later").groupBy("g").agg({"later": "max", "*": "count"})
    sizes = Counter(0 if i % 3 < 2 else i % 50 for i in range(60000))
    assert {r.g: (r["count(1)"], r["max(later)"]) for r in got.collect()} == {
        g: (n, n - 1) for g, n in sizes.items()
    }
