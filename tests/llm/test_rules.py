"""op2: counts against plain Python, the oracle, and what EM finds."""

import re

import duckdb
import pytest
from conftest import SF001

from sparkfold.llm import queries
from sparkfold.llm.rules import RULES, counted, estimate, judge, oracle_sql, votes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {p for places in seen.values() if len(places) > 1 for i in places for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_of_odd_documents(spark, odd, empty):
    extra = spark.createDataFrame([(50, "a b c a b c"), (51, "a a a a"), (52, "x y z\nx y z\n\n x y z"), (53, "a b c d a b c e b c d")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(extra)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in counted(docs).collect()))
    assert got == sorted(plain(r.text) for r in docs.collect())
    rows = judge(odd).collect()
    assert len(rows) == odd.count() and all(r.base_failed is not None and r.kept is not None for r in rows)
    assert not any(r.kept for r in rows if r.base_failed)
    assert judge(empty).count() == 0


def test_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    columns = ["doc_id", *COLUMNS, "base_failed", "kept"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()}) ORDER BY 1").fetchall()
    got = sorted(tuple(r[c] for c in columns) for r in queries.op2_weak_supervision(spark, SF001).collect())
    assert got == want


def test_em_finds_the_accuracies(spark):
    rows = []
    names = [f"v_{name}" for name, *_ in RULES]
    import random
    rng = random.Random(4)
    for _ in range(4000):
        good = rng.random() < 0.8
        rows.append(tuple(-1 if rng.random() < 0.1 else int((rng.random() < 0.97) if good else (rng.random() < 0.4)) for _ in names))
    fitted = estimate(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))).first()
    assert abs(fitted.prior - 0.8) < 0.03
    assert all(abs(g - 0.97) < 0.03 and abs(b - 0.6) < 0.08 for g, b in zip(fitted.good, fitted.bad))


def test_plan_is_native(spark, odd):
    plan = votes(counted(odd))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_junk_goes_and_clean_text_stays(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(labels[r.doc_id], r.kept, r.base_failed) for r in queries.op2_weak_supervision(spark, sf).collect() if r.doc_id in labels]
    good = [kept for q, kept, failed in rows if q == 1 and not failed]
    bad = [kept for q, kept, failed in rows if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)
