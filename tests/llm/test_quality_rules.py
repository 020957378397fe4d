import re
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import quality_rules as Q


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    repeat = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeat)


def test_counts_against_brute_force(awkward, awkward_docs):
    rows = Q.judge(awkward_docs).collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows)
    want = Counter()
    for d, t, *_ in awkward:
        b = brute(t)
        want[d, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]] += 1
    assert got == want
    assert all(isinstance(r["kept"], bool) for r in rows)
    assert not any(r["kept"] for r in rows if r["base_failed"])


def covered(h):
    n = Counter(h)
    return len({j for i, x in enumerate(h) if n[x] > 1 for j in range(i, i + 3)})


def test_windows_whose_hashes_share_high_bits(spark):
    import random

    rng = random.Random(4)
    top = 0x5A5A5A5A << 32
    rows = [[top + 1, top + 2, top + 1], [top + 1, top + 2, top + 1, top + 2], [top + 3, 7, top + 2, 7, top + 1], [], [5, 5, 5], [-1, -2, -1]]
    rows += [[top + rng.randrange(6) if rng.random() < 0.5 else rng.randrange(9) - 4 for _ in range(rng.randrange(30))] for _ in range(60)]
    rows.append([(top + k % 5) - (1 << 63) for k in range(5000)])
    df = spark.createDataFrame([(k, h) for k, h in enumerate(rows)], "k int, h array<long>")
    got = {r["k"]: r["n_repeat_words"] for r in Q._repeat_words(df).collect()}
    assert got == {k: covered(h) for k, h in enumerate(rows)}


def test_a_text_of_very_many_words(spark):
    n = (1 << 24) + 500
    numbers = F.concat(F.sequence(F.lit(1), F.lit(n)), F.array(F.lit(1)))
    df = spark.range(1).select(F.transform(numbers, lambda x: F.xxhash64(x)).alias("h"))
    assert Q._repeat_words(df).select("n_repeat_words").first()[0] == 6


def test_no_rows(no_docs):
    assert Q.judge(no_docs).collect() == []


def test_no_python_in_the_plan(awkward_docs):
    plan = Q.judge(awkward_docs)._jdf.queryExecution().toString()
    counts = Q.text_counts(awkward_docs, "doc_id")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan + counts)


def test_em_finds_planted_accuracies():
    import random

    rng = random.Random(3)
    bad_rate = (0.6, 0.4, 0.5)
    patterns = Counter()
    for _ in range(20000):
        good = rng.random() < 0.8
        votes = tuple(-1 if rng.random() < (0.02 if good else r) else 1 if rng.random() < (0.9 if good else 0.6) else 0 for r in bad_rate)
        patterns[votes] += 1
    f = Q.fit(list(patterns.items()))
    assert abs(f.prior - 0.8) < 0.08
    for j, r in enumerate(bad_rate):
        assert abs(f.rates[j][0][0] - r) < 0.15 and f.rates[j][1][0] < 0.08
        assert f.accuracy(j) > 0.7
    assert f.log_odds((1, 1, 1)) > 0 > f.log_odds((-1, -1, -1))


def test_em_without_data_keeps_the_start():
    assert Q.fit([]).rates == ()
    f = Q.fit([((0, 0), 10)])
    assert f.rates[0][0][0] <= f.rates[0][1][0] + 1 and f.log_odds((1, 1)) >= f.log_odds((-1, -1))


def test_junk_is_told_from_prose(spark):
    import random

    from tests.llm.conftest import prose, words

    rng = random.Random(1)
    docs = [(k, prose(rng, 200)) for k in range(300)]
    docs += [(1000 + k, " ".join(w + "###" for w in words(rng, 200))) for k in range(40)]
    docs += [(2000 + k, " ".join(w.upper() + "!!" for w in words(rng, 200))) for k in range(40)]
    got = {r["doc_id"]: r["kept"] for r in Q.judge(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[k] for k in range(300)) and not any(got[k] for k in got if k >= 1000)
