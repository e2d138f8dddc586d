import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.cases import ROWS, docs, none, odd
from tidemark.llm import decontamination
from tidemark.llm.decontamination import drop_contaminated, find_contamination


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if x]
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def brute(pairs, items):
    """Every window of every document with every item."""
    out = []
    for i, text in pairs:
        hs = shingles(text)
        for k, item in items:
            own, best = shingles(item), 0.0
            for s in range(max(1, len(hs) - len(own) + 1)) if own and hs else ():
                win = hs[s:s + len(own)]
                m = sum((Counter(win) & Counter(own)).values())
                best = max(best, m / (len(win) + len(own) - m))
            if best >= 0.8:
                out.append((i, k, round(best, 9)))
    return sorted(out, key=str)


def found(df, items, spark):
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hs", F.lit(1))
    got = find_contamination(df, bench).collect()
    assert all(0 <= r.bits <= 23 and r.start_word >= 0 for r in got)
    return sorted(((r.doc_id, r.item_id, round(r.similarity, 9)) for r in got), key=str)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgé", k=r.randrange(1, 6)))
    prose = lambda k: [word() for _ in range(k)]
    items = [(k, " ".join(prose(r.randrange(12, 50)))) for k in range(12)]
    items += [(50, items[0][1]), (51, None), (52, ""), (53, "few words"), (54, "la " * 20)]
    texts = []
    for _ in range(150):
        words = prose(r.randrange(60))
        for _ in range(r.randrange(3)):
            own = items[r.randrange(12)][1].split()
            for _ in range(r.randrange(4)):
                at = r.randrange(len(own))
                own[at:at + 1] = r.choice([[], [word()], [own[at], word()]])
            at = r.randrange(len(words) + 1)
            words[at:at] = own
        texts.append((", " if r.random() < 0.3 else " ").join(words).upper() if r.random() < 0.2 else " ".join(words))
    return texts + ["few words", "Few, words!", "few words more here now", "la " * 50, "la " * 8], items


def test_against_all_windows(spark):
    texts, items = corpus(1)
    want = brute(enumerate(texts), items)
    assert len(want) > 25
    assert found(docs(spark, texts), items, spark) == want


def test_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SHINGLES_A_BLOCK", 60)
    texts, items = corpus(2)
    assert found(docs(spark, texts), items, spark) == brute(enumerate(texts), items)


def test_odd_rows(spark):
    items = [(1, "one small text"), (2, "Word after word without end, it goes on and on. Word after"), (None, "x"),
             (3, "no id at all")]
    assert found(odd(spark), items, spark) == brute(ROWS, items)


def test_clean_documents_stay(spark):
    texts, items = corpus(3)
    df = docs(spark, texts).withColumns({"row": F.lit(1), "hs": F.lit(2), "bits": F.lit(3)})
    bench = spark.createDataFrame(items, "item_id long, text string")
    left = drop_contaminated(df, bench)
    assert left.columns == df.columns
    bad = {i for i, _, _ in brute(enumerate(texts), items)}
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(range(len(texts))) - bad)


def test_no_rows(spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert find_contamination(none(spark), bench).count() == 0
    assert find_contamination(docs(spark, ["a"]), bench.limit(0)).count() == 0
    assert drop_contaminated(odd(spark), bench.limit(0)).count() == len(ROWS)


def test_no_python_in_the_plan(spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = find_contamination(odd(spark), bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_repeated_shingles_that_differ(spark):
    words = " ".join(f"u{i}" for i in range(230))
    items = spark.createDataFrame([(f"i{k}", f"{words} v{k} " + f"x{k} " * 26) for k in range(4)], "item_id string, text string")
    docs = spark.createDataFrame([(k, f"{words} v{k} " + f"y{k} " * 26) for k in range(4)], "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_contamination(docs, items).collect()}
    assert {(k, f"i{k}") for k in range(4)} <= found


def test_shared_counts_repeats(spark):
    r = random.Random(4)
    pairs = [([r.randrange(6) for _ in range(r.randrange(1, 12))], [r.randrange(6) for _ in range(r.randrange(1, 12))])
             for _ in range(60)]
    often = [[(h, c) for h, c in Counter(b).items() if c > 1] for _, b in pairs]
    df = spark.createDataFrame([(a, b, o) for (a, b), o in zip(pairs, often, strict=True)],
                               "a array<long>, b array<long>, o array<struct<h:long,times:long>>")
    got = [r.m for r in df.select(decontamination.shared(F.col("a"), F.col("b"), F.col("o")).alias("m")).collect()]
    assert got == [sum((Counter(a) & Counter(b)).values()) for a, b in pairs]


def test_fingerprints_are_majorities(spark):
    r = random.Random(6)
    windows = [[r.getrandbits(64) - (1 << 63) for _ in range(r.randrange(1, 40))] for _ in range(20)] + [[-1], [0]]
    want = {i: sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) for i, hs in enumerate(windows)}
    df = spark.createDataFrame(list(enumerate(windows)), "i long, hs array<long>").select("i", F.size("hs").alias("n"),
                                                                                          F.explode("hs").alias("h"))
    got = df.groupBy("i", "n").agg(*decontamination.bit_sums(F.col("h"))).select(
        "i", decontamination.bits_over(F.col("n")).alias("fp")).collect()
    assert {r.i: r.fp % (1 << 64) for r in got} == want


def test_long_document_that_repeats_an_item(spark):
    """60,000 words, an item over and over: as many windows as words."""
    item = " ".join(f"w{i}" for i in range(60))
    bench = spark.createDataFrame([(1, item), (2, item + " and some more words at its end")], "item_id long, text string")
    got = find_contamination(docs(spark, [f"{item} " * 1_000, f"x {item} " * 100]), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.similarity) for r in got if r.item_id == 1) == [(0, 1, 1.0), (1, 1, 1.0)]


def test_columns_of_any_name_stay(spark):
    left = drop_contaminated(odd(spark), spark.createDataFrame([(1, "one small text")], "item_id long, text string"))
    assert left.columns == odd(spark).columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [2, 3, 4, 5, 6, 7, 7, 8]
