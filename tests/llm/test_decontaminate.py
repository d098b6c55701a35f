import hashlib
import random
import re

from pyspark.sql import functions as F

from pricelens.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, span=13):
    out = []
    windows = {}
    for item, text in items:
        w = _words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault((n, tuple(w[i:i + n])), set()).add("" if item is None else str(item))
    sizes = {n for n, _ in windows}
    for d, text in docs:
        w = _words(text)
        hit, ids = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = windows.get((n, tuple(w[i:i + n])))
                if found:
                    hit |= set(range(i, i + n))
                    ids |= found
        out.append((d, len(w), len(hit), ",".join(sorted(ids))))
    return sorted(out, key=str)


def run(docs, items):
    got = decontaminate(docs, items)
    return sorted(((r["doc"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in got.collect()), key=str)


def test_equals_brute_force_on_random_texts_of_few_words(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "C", "é", "0"]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, line(n)) for i, n in enumerate([0, 1, 3, 4, 7, 12, 13, 14, 20, 30, 30])]
    items += [(50, items[-1][1]), (None, items[8][1])]
    docs = [(i, line(rng.randint(0, 80))) for i in range(40)]
    docs += [(100 + i, f"{line(5)}, {t.upper()}. {line(4)}") for i, (_, t) in enumerate(items)]
    got = run(spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(docs, items)


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog again and again today x"),
                                   (2, None), (None, ""), (3, "sechs")],
                                  "item_id long, text string").withColumn("fp", F.lit(1))
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    its = [(r["item_id"], r["text"]) for r in items.collect()]
    assert run(odd_docs, items) == brute(docs, its)
    assert run(no_docs, items) == []
    assert all(r[2] == 0 for r in run(odd_docs, items.where("false")))


def test_sha_of_no_items_is_that_of_the_empty_string(spark):
    from pricelens.llm.queries import op1_winnowing
    got = op1_winnowing(spark, "/root/testdata/sf0.001").where("n_items = 0").first()
    assert got["items_sha256"] == hashlib.sha256(b"").hexdigest()
