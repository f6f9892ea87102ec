from __future__ import annotations

import duckdb
import pytest

from conftest import rows
from tillwatch.llm import line_dedup as L
from tillwatch.llm.common import table
from tillwatch.llm.queries import op5_line_dedup


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    sql = con.execute(f"SELECT doc_id, n_lines, n_cut, n_chars, text_sha256 FROM ({L.ORACLE})").fetchall()
    got = rows(op5_line_dedup(spark, sf), "doc_id", "n_lines", "n_cut", "n_chars", "text_sha256")
    assert got == sorted(sql, key=repr)
    assert any(r[2] for r in got)


@pytest.fixture(scope="module")
def edge(spark):
    shared = "this line is everywhere"
    data = [(i, f"{shared}\nown line number {i}\n  {shared} ", f"s{i % 7}", "c") for i in range(14)]
    data += [(20, None, "s1", "c"), (21, "", "s2", "c"), (22, "own line number 3\nshort one", "s3", "c"),
             (None, shared, "s4", "c"), (23, "x\n" * 20_000 + shared, None, "c"),
             *[(30 + i, "no no\nfour sites only here", f"s{i % 4}", "c") for i in range(20)],
             *[(60 + i, "short one", f"s{i}", "c") for i in range(9)]]
    return spark.createDataFrame(data, "doc_id long, text string, source string, cut string")


def test_edges(edge):
    got = {r["doc_id"]: r for r in L.cut_lines(edge).collect()}
    assert got[None]["text"] == "this line is everywhere"  # the first occurrence
    assert got[0]["text"] == "own line number 0" and got[0]["lines_cut"] == 2 and got[0]["lines_before"] == 3
    assert got[20]["text"] is None and got[20]["lines_before"] == 0 and got[21]["text"] == ""
    assert got[22]["text"] == "own line number 3\nshort one"
    assert got[23]["lines_cut"] == 1 and got[23]["text"].endswith("x")
    assert all(got[i]["lines_cut"] == 0 for i in [*range(30, 50), *range(60, 69)])
    assert set(edge.columns) < set(L.cut_lines(edge).columns)


def test_without_broadcast(edge, monkeypatch):
    expected = rows(L.digest(L.cut_lines(edge)))
    monkeypatch.setattr(L, "small", lambda df: df)
    assert rows(L.digest(L.cut_lines(edge))) == expected


def test_empty(edge):
    assert L.cut_lines(edge.limit(0)).count() == 0


SCRIPTS = {
    "zh": "本网站的所有内容均受版权保护未经许可不得转载", "ja": "お問い合わせはこちらからお願いします",
    "th": "สงวนลิขสิทธิ์ตามกฎหมายห้ามคัดลอก", "tabs": "Home\tNews\tContact", "no-break": "Tous\u00a0droits\u00a0réservés",
    "wide": "版权\u3000所有\u3000翻印", "one word": "Datenschutzgrundverordnungserklärung",
}


def plain(data, min_sites=5):
    """The intended rule: what is left of each text."""
    def line(raw):
        return " ".join(raw.replace("\ufeff", " ").replace("\u200b", " ").replace("\u2060", " ").split())

    at = {}
    for doc_id, text, site in data:
        for i, raw in enumerate(text.split("\n")):
            words = line(raw)
            if len(words.split()) >= 3 or len(words.encode()) >= 24:
                at.setdefault(words, []).append((doc_id, i, site))
    cut = {(d, i) for found in at.values() if len({s for _, _, s in found}) >= min_sites
           for d, i, _ in found if (d, i) != min(found)[:2]}
    return {d: "\n".join(raw for i, raw in enumerate(text.split("\n")) if (d, i) not in cut) for d, text, _ in data}


def test_every_script_and_white_space(spark):
    lines = list(SCRIPTS.values())
    data = [(i, "\n".join([f"own line number {i}", *lines, "首页", "Home"]), f"s{i % 6}") for i in range(12)]
    data += [(20, "\u00a0Home News\u2003 Contact\ufeff\nTous droits  réservés\t\r\n\u3000版权 所有 翻印", "s9"),
             (21, "\n".join([lines[0] + "一", "\u3000", "\t", ""]), "s9")]
    got = {r["doc_id"]: r["text"] for r in L.cut_lines(
        spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert got == plain(data)
    assert got[0] == data[0][1] and got[5] == "own line number 5\n首页\nHome"
    assert got[20] == "" and got[21] == data[-1][1]
