import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pricelens.llm import fingerprints as P


def units(t, scale):
    return set(re.findall(P.SCALES[scale][1], t))


def brute(docs):
    """By (id, hash of the text) like the operator; the hash only matters for equal ids."""
    rows = sorted(((d, t or "") for d, t in docs), key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0))
    scale = lambda *t: sum(max(map(len, t)) >= P.SCALES[i][0] for i in (0, 1))

    def like(a, b, at):
        x, y = units(a, at), units(b, at)
        return len(x & y) / len(x | y) if x | y else 1.0
    out = {}
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), like(t, edited, scale(t)), like(t, nxt, scale(t, nxt)))
    return out


def check(got, docs):
    want = brute(docs)
    assert len(got) == len(docs)
    for r in got:
        n, sha, near, nxt = want[r["doc"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha), r["doc"]
        assert r["near_edited"] == pytest.approx(near) and r["near_next"] == pytest.approx(nxt)


def test_equals_exact_sets_and_edited_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = P.fingerprint_documents(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    check(got, list(texts.items()))
    by = {}
    for r in got:
        by.setdefault(texts[r["doc"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)
    assert all(re.fullmatch("[0-9a-f]{32}", r["fingerprint"]) for r in got)


def test_failing_sketches_are_retried_larger(spark, monkeypatch):
    """With one round hardly a pair peels at first; the results stay the same."""
    monkeypatch.setattr(P, "_size", lambda n: F.greatest(F.lit(1), (n / 8).cast("long")).cast("long"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 40")
    check(P.fingerprint_documents(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_peeling_recovers_a_difference(spark):
    units = spark.createDataFrame(
        [(1, "p", 64, 1, list(range(100, 160))), (1, "p", 64, -1, list(range(130, 170)))],
        "rid long, pair string, cells long, n long, keys array<long>")
    got = P._cells(units, 12).collect()
    assert [(r["found"], r["whole"]) for r in got] == [(40, True)]


def test_odd_rows_and_small_tables(spark, odd_docs, no_docs):
    rows = odd_docs.dropDuplicates(["doc_id"])
    check(P.fingerprint_documents(rows).collect(), [(r["doc_id"], r["text"]) for r in rows.collect()])
    everything = P.fingerprint_documents(odd_docs).collect()
    assert len(everything) == odd_docs.count()
    assert P.fingerprint_documents(no_docs).count() == 0
    check(P.fingerprint_documents(rows.where("doc_id = 1")).collect(),
          [(1, rows.where("doc_id = 1").first()["text"])])


def test_large_and_string_ids_keep_their_order(spark):
    rows = [((1 << 55) + i, f"Text number {i} of a document that says {i * 7} things.") for i in range(60)]
    rows += [(-(1 << 60), "least of all"), (None, "no id"), ((1 << 62) + 1, "most of all")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(P.fingerprint_documents(df).collect(), rows)
    named = [(f"id-{i * 37 % 101:03d}", f"Text {i}. More of it {i * i}.") for i in range(90)] + [("é", "x"), ("漢", "y")]
    df = spark.createDataFrame(named, "doc_id string, text string").repartition(5)
    got = P.fingerprint_documents(df).collect()
    order = sorted(named)
    follow = {d: order[(i + 1) % len(order)][1] for i, (d, _) in enumerate(order)}
    for r in got:
        t = dict(named)[r["doc"]]
        edited = t[:len(t) - len(t) // 4] + follow[r["doc"]][:len(t) // 4]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_rows_of_one_id_follow_one_another(spark):
    rows = [(7, f"Text {i} under one id.") for i in range(300)] + [(None, f"Text {i} without id.") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    chain = P.with_next(df, "doc_id", "text", 16).collect()
    assert len({r["bucket"] for r in chain}) > 8
    step = {r["text"]: r["next"] for r in chain}
    at, seen = rows[0][1], []
    for _ in rows:
        seen.append(at)
        at = step[at]
    assert at == rows[0][1] and len(set(seen)) == len(rows)  # one ring through all rows


@pytest.mark.parametrize("text", ["short words make up this little text here", "x" * 10 + "abcdefghijklmnopqrstuvwxyz0123456789",
                                  "一二三四五六七八九十" * 5, "One sentence. " * 3 + "Another one at the end of it all."])
def test_a_short_text_is_like_its_edit(spark, text):
    df = spark.createDataFrame([(1, text), (2, "QQQ QQQ QQQ " * 40)], "doc_id long, text string")
    got = {r["doc"]: r for r in P.fingerprint_documents(df).collect()}
    assert got[1]["near_edited"] > 0.25 and got[1]["near_next"] == 0.0


def test_no_given_text_is_unlike_its_edit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert P.fingerprint_documents(docs).where("n_chars >= 40 and near_edited < 0.2").count() == 0
