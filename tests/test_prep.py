"""Encoding and BLEU; BLEU is checked against a plain-Python statement of the
public definition (13a tokens, clipped counts, brevity penalty, exp smoothing)."""

import math
import random
import re
from collections import Counter


from parcorpus.operators import bleu, prep
from pyspark.sql import functions as F
from tests.conftest import rows


def test_encode_fixed(spark):
    df = spark.createDataFrame([(1, "a b", "a b"), (2, "a b c d e f", "f")], "pos int, prompt string, target string")
    vocab = prep.build_vocab(df, ["prompt"], 10)
    enc = prep.encode_fixed(df, vocab, max_len=4).orderBy("pos")
    got = rows(enc, "input_ids", "attention_mask")
    assert len(got[0][0]) == 4 and got[0][0][2:] == [0, 0] and got[0][1] == [1, 1, 0, 0]
    assert got[1][1] == [1, 1, 1, 1] and all(i >= 3 for i in got[1][0])
    dec = prep.decode_ids(enc, "input_ids", vocab)
    assert rows(dec.orderBy("pos"), "decoded") == [("a b",), ("a b c d",)]


def _tok(line):
    line = line.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    if "&" in line:
        line = line.replace("&quot;", '"').replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
    line = f" {line} "
    for pat, rep in [(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
                     (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")]:
        line = re.sub(pat, rep, line)
    return line.split()


def py_bleu(hyps, refs):
    correct, total, sys_len, ref_len = [0] * 4, [0] * 4, 0, 0
    for h, r in zip(hyps, refs):
        ht, rt = _tok(h), _tok(r)
        sys_len += len(ht)
        ref_len += len(rt)
        for n in range(1, 5):
            hc = Counter(tuple(ht[i:i + n]) for i in range(len(ht) - n + 1))
            rc = Counter(tuple(rt[i:i + n]) for i in range(len(rt) - n + 1))
            correct[n - 1] += sum(min(c, rc[g]) for g, c in hc.items())
            total[n - 1] += max(len(ht) - n + 1, 0)
    if not any(correct):
        return 0.0
    prec, smooth = [0.0] * 4, 1.0
    for n in range(4):
        if total[n] == 0:
            break
        if correct[n] == 0:
            smooth *= 2
            prec[n] = 100.0 / (smooth * total[n])
        else:
            prec[n] = 100.0 * correct[n] / total[n]
    bp = 1.0 if sys_len >= ref_len else (math.exp(1 - ref_len / sys_len) if sys_len > 0 else 0.0)
    return bp * math.exp(sum(math.log(p) if p > 0 else -9999999999 for p in prec) / 4)


def _spark_bleu(spark, pairs):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "id long, h string, r string")
    return bleu.corpus_bleu(df, "h", "r").first()["bleu"]


def test_bleu_fixture_cases(spark):
    same = [("the cat sat on the mat", "the cat sat on the mat")]
    assert abs(_spark_bleu(spark, same) - 100.0) < 1e-9
    assert _spark_bleu(spark, [("a b c d", "w x y z")]) == 0.0
    v = _spark_bleu(spark, [("a b x y", "a b z w")])
    assert v > 0 and abs(v - py_bleu(["a b x y"], ["a b z w"])) < 1e-9
    assert _spark_bleu(spark, [("a b c", "a b c")]) == 0.0


def test_bleu_matches_python(spark):
    rnd = random.Random(11)
    words = ["the", "cat", "sat", "on", "mat", "dog", "2,5", "(x)", "end.", "a-b", "&amp;", "3-4"]
    pairs = [(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12))),
              " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12)))) for _ in range(60)]
    got = _spark_bleu(spark, pairs)
    want = py_bleu([p[0] for p in pairs], [p[1] for p in pairs])
    assert abs(got - want) < 1e-9


def test_clipped_matches_are_a_multiset_intersection(spark):
    rnd = random.Random(5)
    sides = [([], []), ([1], []), ([-3, -3, 2], [2, -3, -3, -3])]
    sides += [tuple([rnd.choice([2 * k for k in range(-4, 5)]) for _ in range(rnd.randint(0, 20))] for _ in "ab") for _ in range(80)]
    sides += [(list(range(0, 40, 2)), [rnd.randrange(0, 60, 2) for _ in range(50)])]
    df = spark.createDataFrame(sides, "a array<long>, b array<long>")
    got = rows(df.select("a", "b", bleu.clipped_matches(F.col("a"), F.col("b")).alias("n")))
    assert [n for _, _, n in got] == [sum((Counter(a) & Counter(b)).values()) for a, b, _ in got]


def test_bleu_of_long_repetitive_rows_and_missing_sides(spark):
    rnd = random.Random(12)
    pairs = [(" ".join(rnd.choice("ab,") for _ in range(700)), " ".join(rnd.choice("abc.") for _ in range(500))) for _ in range(5)]
    pairs += [("", "a b"), ("a , .. 1.5, a..b - 3-4 !", "a , . . 1.5 , a..b -- 3 - 4!")]
    assert abs(_spark_bleu(spark, pairs + [(None, "a"), ("a", None)]) - py_bleu(*zip(*pairs))) < 1e-9


def test_no_ngram_leaves_its_row(spark):
    df = spark.createDataFrame([("a b", "a b", 1)], "h string, r string, g int")
    plan = bleu.corpus_bleu(df, "h", "r", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange") == 1, plan


def test_equal_rows_stay_apart(spark):
    df = spark.createDataFrame([(1, "a b", "c")] * 3 + [(1, None, "")], "pos int, prompt string, target string")
    vocab = prep.build_vocab(df.fillna(""), ["prompt", "target"], 10)
    enc = prep.encode_fixed(df, vocab, max_len=3)
    assert sorted(map(str, rows(enc, "pos", "attention_mask"))) == ["(1, [0, 0, 0])"] + ["(1, [1, 1, 0])"] * 3
    back = sorted(rows(prep.decode_ids(enc, "input_ids", vocab), "decoded"))
    assert back == [("",), ("a b",), ("a b",), ("a b",)]
    st = bleu.bleu_stats(spark.createDataFrame([("x y", "x y")] * 2, "h string, r string"), "h", "r").first()
    assert (st["total_2"], st["total_3"], st["correct_2"]) == (2, 0, 2)


def test_places_of_long_conversations_and_documents_do_not_meet(spark):
    import os
    import tempfile

    from parcorpus.plans import views as V
    d = tempfile.mkdtemp(prefix="parcorpus-views-")
    turns = [(0, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(1002)] + [(1, 0, "user", "u"), (1, 1, "assistant", "a")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(os.path.join(d, "conversations.parquet"))
    docs = [(0, "\n".join(f"l{i}" for i in range(100_001)), "en", "no number"), (1, "x", "fr", "src1"), (2, "y\nz", "en", "src1")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(os.path.join(d, "documents.parquet"))
    p = V.pairs(spark, d)
    assert p.count() == 502 and p.select("pos").distinct().count() == 502
    for view in (V.verses_long, V.doc_pairs):
        v = view(spark, d)
        assert v.count() == 100_004 and v.select("pos").distinct().count() == 100_004
    ordered = [r["doc_id"] for r in V.doc_pairs(spark, d).orderBy("pos").select("doc_id").collect()]
    assert ordered == sorted(ordered)
    assert rows(V.doc_pairs(spark, d).where("doc_id = 2").orderBy("line"), "src", "tgt") == [("y", "z"), ("z", "y")]
    assert V.books(spark, d).select("id").distinct().count() == 2


def test_look_up_deals_rows_evenly(spark):
    """With broadcasts off no key of the look-up's exchange holds more than its share: rows have no common key,
    and a token on every row is dealt over the copies of the vocabulary."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(k, "the the w", f"x{k}") for k in range(400)], "pos int, prompt string, target string")
        vocab = prep.build_vocab(df, ["prompt"], 10)
        enc = prep.encode_fixed(df, vocab, max_len=3)
        plan = enc._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_key" in plan and "hashpartitioning(token#" not in plan.replace("hashpartitioning(token#", "", 1), plan
        got = {r["pos"]: (list(r["input_ids"]), list(r["labels"])) for r in enc.collect()}
        the, w = ({r["token"]: r["id"] for r in vocab.collect()}[t] for t in ("the", "w"))
        assert got == {k: ([the, the, w], [prep.UNK_ID, 0, 0]) for k in range(400)}
        back = prep.decode_ids(enc, "input_ids", vocab)
        assert {r["decoded"] for r in back.collect()} == {"the the w"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
