import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.data import documents, empty
from tidemark.llm import hostrules as H


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_measures_against_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", " ", "a", "a b", "a b c", "a b c a b c", "a a a a", "\n\n a\n a\n", "x\r\nx\r\n#*$%&|<>"]
    for _ in range(60):
        parts = rng.choices(["a", "b", "cc", "é", "\U0001f600", "#", " ", "\n", "\t", "\x0b", "\x85"], k=rng.randrange(90))
        texts.append(rng.choice(["", " "]).join(parts))
    texts.append(" ".join(f"w{rng.randrange(40)}" for _ in range(3000)))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("source", F.lit("s"))
    got = {r["i"]: r for r in H.measured(df).select("row.i", *H.MEASURES).collect()}
    for i, t in enumerate(texts):
        assert {k: got[i][k] for k in H.MEASURES} == slow(t), repr(t)


def host_rows(spark, sizes):
    """(host, failing, clean) as documents: failing ones are too short."""
    rows = []
    for host, bad, good in sizes:
        rows += [(host, "x")] * bad + [(host, " ".join(f"word{i}" for i in range(60)))] * good
    return spark.createDataFrame(rows, "source string, text string")


def test_rates_are_shrunk_to_the_prior(spark):
    sizes = [("a", 90, 10), ("b", 5, 95), ("c", 1, 0), ("d", 10, 90), ("e", 0, 50)]
    got = {r["host"]: r for r in H.host_verdicts(H.measured(host_rows(spark, sizes))).collect()}
    f, n = sum(x[1] for x in sizes), sum(x[1] + x[2] for x in sizes)
    m, own = f / n, [x[1] / (x[1] + x[2]) for x in sizes]
    v = sum(x * x for x in own) / 5 - 2 * m * sum(own) / 5 + m * m
    strength = max(1.0, m * (1 - m) / v - 1)
    for host, bad, good in sizes:
        rate = (bad + m * strength) / (bad + good + strength)
        assert abs(got[host]["rate"] - rate) < 1e-9
        assert got[host]["bad"] == (rate > 0.5)


def test_one_host_and_equal_hosts_have_the_common_rate(spark):
    for sizes in ([("a", 3, 7)], [("a", 3, 7), ("b", 6, 14)]):
        rates = [r["rate"] for r in H.host_verdicts(H.measured(host_rows(spark, sizes))).collect()]
        assert all(abs(r - 0.3) < 1e-9 for r in rates)


def test_clean_documents_stay_at_bad_hosts(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"word{i}#" for i in range(60))
    rows = [("bad", "x")] * 40 + [("bad", clean), ("bad", noisy)] + [("good", clean)] * 40 + [("good", noisy)]
    kept = H.kept(spark.createDataFrame(rows, "source string, text string"))
    assert Counter(map(tuple, kept.collect())) == {("bad", clean): 1, ("good", clean): 40, ("good", noisy): 1}


def test_rows_of_all_kinds(spark):
    docs = documents(spark)
    kept = H.kept(docs)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} <= {1, 2, 5, None}
    assert H.kept(empty(spark)).count() == 0


def test_no_python_runs(spark):
    plan = H.measured(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
