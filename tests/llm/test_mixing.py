import random

import duckdb
import pytest
from cases import EDGES, documents, edge_docs, no_docs

from tradewind.llm import mixing as M
from tradewind.llm.oracles import mixing_oracle


def by_sql(frame, mix):
    connection = duckdb.connect()
    connection.register("documents", frame.select("doc_id", "text", "lang", "source").toPandas())
    return sorted(connection.execute(mixing_oracle(mix)).fetchall(), key=str)


@pytest.mark.parametrize("mix", [M.PRODUCTION, M.Mix(epochs=1, share=(1, 3)), M.Mix(epochs=2, share=(3, 1)),
                                 M.Mix(weights={"lang": {"en": 50}}, share=(1, 2), seed="other"),
                                 M.Mix(domains=M.PRODUCTION.domains, weights={"domain": {"web": 0}, "lang": {"de": 0}, "source": {"src3": 0}}, share=(1, 2))])
def test_documents_equal_sql(spark, small, mix):
    docs = documents(spark, small)
    got = sorted((tuple(r) for r in M.mix_sources(docs, mix).collect()), key=str)
    assert got == by_sql(docs, mix)


def test_edges_equal_sql(spark):
    got = sorted((tuple(r) for r in M.mix_sources(edge_docs(spark), M.Mix(share=(1, 2), epochs=1)).collect()), key=str)
    assert len(got) == len(EDGES)
    assert [(r[0], r[4]) for r in got] == [(r[0], r[4]) for r in sorted(got, key=str)]
    assert M.mix_sources(no_docs(spark)).count() == 0


def poured(total, children):
    """Water filling by repeated sharing; children are name: (weight, capacity)."""
    given, open_ = {}, dict(children)
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = {n for n, (w, c) in open_.items() if c * weight <= total * w}
        if not full:
            given.update({n: total * w // weight for n, (w, _) in open_.items()})
            break
        for name in full:
            given[name] = open_.pop(name)[1]
            total -= given[name]
    return given


def test_shortages_go_to_siblings(spark):
    random.seed(5)
    for _ in range(6):
        children = {f"c{i}": (random.randint(1, 9), random.choice([0, 5, 50, 500, 5000])) for i in range(8)}
        total = random.randint(0, sum(c for _, c in children.values()))
        frame = spark.createDataFrame([(0, n, w, c, total) for n, (w, c) in children.items()],
                                      "root int, name string, weight long, capacity long, parent_budget long")
        got = {r.name: r.budget for r in M.fill(frame, ["root"], "name").collect()}
        assert got == poured(total, children)


def test_weights_are_met_and_closed_leaves_stay_out(spark):
    docs = spark.range(4000).selectExpr(
        "id as doc_id", "concat_ws(' ', array_repeat('w', cast(1 + id % 7 as int))) as text", "'en' as lang",
        "case when id % 4 = 0 then 's1' when id % 4 = 1 then 's2' else 's3' end as source")
    mix = M.Mix(weights={"source": {"s1": 3, "s2": 1, "s3": 0}}, epochs=10, share=(1, 2))
    rows = M.mix_sources(docs, mix).collect()
    taken = {s: sum(r.tokens * r.copies for r in rows if r.source == s) for s in ("s1", "s2", "s3")}
    total = sum(r.tokens for r in rows) // 2
    assert taken["s3"] == 0 and abs(taken["s1"] - total * 3 / 4) <= 7 and abs(taken["s2"] - total / 4) <= 7


def test_closed_leaves_give_nothing_and_open_ones_their_empty_documents(spark):
    docs = spark.createDataFrame([(1, "", "en", "shut"), (2, None, "en", "shut"), (3, "a b", "en", "shut"), (4, "", "en", "open"), (5, "a b c", "en", "open"),
                                  (6, "", "en", "blank")], "doc_id long, text string, lang string, source string")
    mix = M.Mix(weights={"source": {"shut": 0}}, epochs=1)
    assert {r.doc_id: r.copies for r in M.mix_sources(docs, mix).collect()} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1}
