from __future__ import annotations

import zlib

import pytest

from tillwatch.llm import language_id as K
from tillwatch.llm.common import table
from tillwatch.llm.queries import op10_language_id


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    got = op10_language_id(spark, sf).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.fixture(scope="module")
def edge(spark):
    en = "the cat and the dog walk through the old town with their friends "
    de = "der hund und die katze gehen durch die alte stadt mit ihren freunden "
    data = [(i, en * 3, "en", "k") for i in range(20)] + [(i + 20, de * 3, "de", "k") for i in range(20)]
    data += [(100, None, "en", ""), (101, "", "de", ""), (102, "123 ... ²", None, ""), (None, de, None, ""),
             (103, "THE CAT", None, ""), (104, "die katze " * 40_000, None, ""), (104, "the dog", None, ""),
             (105, "東京", None, ""), (106, "x²", None, "")]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, entropy string")


def test_edges(edge):
    got = [(r["doc_id"], r["lang_pred"]) for r in K.identify(edge).collect()]
    assert len(got) == 49
    for expected in [(100, "und"), (101, "und"), (102, "und"), (None, "de"), (103, "en"), (104, "de"), (104, "en")]:
        assert expected in got
    assert dict(got)[105] in ("de", "en") and dict(got)[106] in ("de", "en")
    rejected = {r["doc_id"] for r in K.identify(edge).collect() if r["rejected"]}
    assert {100, 101, 102, 105} <= rejected and not rejected & set(range(40))


def test_no_training_rows_and_empty(edge):
    unknown = edge.withColumn("lang", edge["text"].substr(1, 0).cast("string")).drop("lang").selectExpr(
        "doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in K.identify(unknown).collect()} == {"und"}
    assert K.identify(edge.limit(0)).count() == 0


def test_probabilities_sum_to_one():
    """Of what can follow a context, seen letters get one less the weight of the unseen."""
    import numpy as np
    model = K.Model(["\x02\x02\x02a", "\x02\x02ab", "\x02abc", "\x02abd", "abc\x03", "abd\x03"],
                    np.array([5, 5, 3, 2, 3, 2]))
    scorer = K.Scorer({"x": model})
    scorer.learn(["abc", "abd", "zzz"])
    seen, other, odd = scorer.known[:, 0]
    assert seen > other > odd and np.exp(seen) + np.exp(other) <= 1.0


def test_models_as_tables_use_every_gram(spark, edge, monkeypatch):
    """Many grams, most of them seen once: cross-entropies are those of models built whole."""
    def found():
        return sorted(((r["doc_id"], r["lang_pred"], r["rejected"], r["score"], r["cross_entropy"])
                       for r in K.identify(data).collect()), key=repr)

    han = [(200 + i, "".join(chr(0x4E00 + (37 * i + 101 * j * j) % 9000) for j in range(40)), "zh", "") for i in range(40)]
    data = edge.unionByName(spark.createDataFrame(han, edge.schema))
    expected = found()
    monkeypatch.setattr(K, "SENT_GRAMS", 50)
    monkeypatch.setattr(K, "train", None)
    got = found()
    assert [g[:3] for g in got] == [e[:3] for e in expected] and len(got) == 89
    for g, e in zip(got, expected):
        assert g[3] == pytest.approx(e[3], abs=1e-9) and g[4] == (None if e[4] is None else pytest.approx(e[4], abs=1e-9))
