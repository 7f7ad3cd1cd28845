from keelgraph.llm.duplicates import _roots, rooted_records


def test_two_slips_of_an_unstored_name(spark):
    things = [f"{i}号{p}{c}检验" for i in range(12) for p in ("左舷", "右舷", "上层", "下层") for c in ("舱盖", "轴承", "底板")]
    known = [f"{i}号左舷舱益检验" for i in range(3)]
    names = [*things, *known, "21号上层底底板检验", "21号上上层底板检验", "22号右舷舱益检验", "22号右舷舱盖检检验", "23号上层底底板检验"]
    df = spark.createDataFrame(list(enumerate(names)), "entity_id long, entity_name string")
    rooted = rooted_records(df, "entity_id", "entity_name").collect()
    smallest = {root: min(r.entity_id for r in rooted if r.root == root) for root in {r.root for r in rooted}}
    first = {names[r.entity_id]: names[smallest[r.root]] for r in rooted}
    assert first["21号上上层底板检验"] == "21号上层底底板检验" and first["22号右舷舱盖检检验"] == "22号右舷舱益检验"
    assert first["23号上层底底板检验"] == "23号上层底底板检验" and all(first[t] == t for t in things)


def test_roots_of_long_chains_and_circles(spark):
    chain = [(f"k{i:02}", f"k{i + 1:02}") for i in range(40)]
    circles = [("a", "b"), ("b", "a"), ("x", "y"), ("y", "z"), ("z", "x"), *[(f"t{i}", f"t{i + 1}") for i in range(5)], ("t5", "z")]
    got = {r.key: r.root for r in _roots(spark.createDataFrame(chain + circles, "key string, root string")).collect()}
    assert all(got[k] == "k40" for k, _ in chain) and got["b"] == "a" and "a" not in got
    assert {got[k] for k in ("x", "y", "z", "t0", "t5")} == {"x"}
