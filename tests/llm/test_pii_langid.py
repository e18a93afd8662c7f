import random
import re
import unicodedata
from collections import defaultdict

import numpy as np

from pyspark.sql import functions as F

from parcorpus.llm import langid, pii
from parcorpus.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
KEY = b"k"


def test_detection():
    t = ("mail Bob.X@Mail5.example.com### call +1 (743) 555-3824, 555 123 4567; ip 227.5.221.1. or 1.2.3.999 "
         "card 4737 0976-84299439 4785380592391139$$$ token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" Mrs. Anna Berg and "
         "Herr Müller saw госпожа no, Госпожа Анна Иванова; 12345 3.14 2024-01-02 a@b @c.com")
    found = [(k, f) for _, _, k, f in pii.detect(t)]
    assert found == [("email", "bob.x@mail5.example.com"), ("phone", "17435553824"), ("phone", "5551234567"), ("ip", "227.5.221.1"),
                     ("card", "4737097684299439"), ("card", "4785380592391139"), ("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"),
                     ("name_f", "anna berg"), ("name_m", "müller"), ("name_f", "анна иванова")]


def test_surrogates_keep_type_and_form():
    for kind, form in (("phone", "17435553824"), ("card", "4737097684299439"), ("card", "4785380592391139"), ("secret", "ab12" * 8)):
        new = pii.surrogate(KEY, kind, form, 0)
        assert len(new) == len(form) and new != form and new == pii.surrogate(KEY, kind, form, 0)
        assert new != pii.surrogate(b"other", kind, form, 0)
    assert pii.luhn(pii.surrogate(KEY, "card", "4111111111111111", 0)) == 0
    assert pii.luhn(pii.surrogate(KEY, "card", "4111111111111112", 0)) != 0
    assert pii.in_form("+1 (743) 555-3824", "phone", "19998887777") == "+1 (999) 888-7777"
    assert re.fullmatch("[а-я]+ [а-я]+а", pii.surrogate(KEY, "name_f", "анна иванова", 0))
    assert pii.in_form("ANNA  Berg", "name_f", "mira tova") == "MIRA  Tova"
    assert pii.surrogate(KEY, "email", "a.b@mail.org", 0).endswith("@" + pii.surrogate(KEY, "email", "zz@mail.org", 0).split("@")[1])


def test_distinct_even_when_draws_collide(spark):
    # one-syllable names: 16 draws for 60 names, so most must draw again and longer
    names = [(f"name_f", a + b) for a in "bcdfgh" for b in "aeiouyklmn"]
    got = pii.assign(spark.createDataFrame(names, "kind string, form string"), KEY).collect()
    assert {r["form"] for r in got} == {n for _, n in names}
    assert len({r["new"] for r in got}) == len(names) and not {r["new"] for r in got} & {n for _, n in names}


def test_replacement_in_texts(spark):
    rows = [(1, "x bob@a.org y 10.0.0.1", "p"), (2, "BOB@A.ORG 10.0.0.1 10.0.0.2", None), (2, "BOB@A.ORG 10.0.0.1 10.0.0.2", None),
            (3, None, "q"), (None, "", "r"), (4, "é " * 100000 + "+1 (743) 555-3824", "s"), (5, "call 743 555 3824 or 743-555-3824", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _entities string")
    out = pii.replace_entities(df, KEY)
    assert out.columns == [*df.columns, "n_entities"]
    got = sorted(((r["doc_id"] or 0, r["text"], r["_entities"], r["n_entities"]) for r in out.collect()), key=repr)
    by = {g[0]: g for g in got}
    assert len(got) == 7 and by[0][1] == "" and by[3][1] is None and by[3][3] == 0
    mail, ip = by[1][1].split()[1], by[1][1].split()[3]
    assert "bob@a.org" not in by[1][1] and by[2][1].split()[0].lower() == mail and by[2][1].split()[1] == ip
    assert by[2][1].split()[2] not in (ip, "10.0.0.2") and by[2][3] == 3
    assert by[4][1].startswith("é é") and "555-3824" not in by[4][1]
    a, b = re.findall(r"\d{3}[ -]\d{3}[ -]\d{4}", by[5][1])
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    assert pii.replace_entities(df.limit(0), KEY).count() == 0


def test_query_leaves_no_entity(spark):
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    forms = {(k, f) for t in before.values() for _, _, k, f in pii.detect(t)}
    rows = QUERIES["op6_pii_surrogates"](spark, SF).collect()
    assert len(rows) == len(before) and forms
    after = {(k, f) for r in rows for _, _, k, f in pii.detect(r["text"])}
    assert not forms & after and len(after) == len(forms)
    assert all(r["text"] == before[r["doc_id"]] for r in rows if r["n_entities"] == 0)


def test_untitled_and_shortened_mentions():
    t = "Mr. John  Smith, then John Smith; SMITH and John. Mr. Smith! Mrs. Smith? Dr. Smith Mr. 王伟, 王伟 Smithson john"
    names = [(t[a:b], k, f) for a, b, k, f in pii.detect(t)]
    assert names == [("John  Smith", "name_m", "john smith"), ("John Smith", "name_m", "john smith"), ("SMITH", "name_m", "john smith"),
                     ("John", "name_m", "john smith"), ("Smith", "name_m", "john smith"), ("Smith", "name_f", "smith"),
                     ("Smith", "name_m", "john smith"), ("王伟", "name_m", "王伟"), ("王伟", "name_m", "王伟")]
    assert pii.in_form("SMITH", "name_m", "kalen divon", "john smith") == "DIVON"
    assert pii.detect("John Smith") == []


def test_script_case_and_check_digits_are_kept():
    new = pii.surrogate(KEY, "name_m", "王伟", 0)
    assert len(new) == 2 and new != "王伟" and all("CJK" in unicodedata.name(c) for c in new)
    assert all("HANGUL" in unicodedata.name(c) for c in pii.surrogate(KEY, "name_f", "김민지", 3))
    form = pii.in_form("Bob.X@Mail.Org", "email", pii.surrogate(KEY, "email", "bob.x@mail.org", 0), "bob.x@mail.org")
    assert re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z]@[A-Z][a-z]{3}\.Example", form)
    account = "DE89 3704 0044 0532 0130 00"
    assert [(k, f) for _, _, k, f in pii.detect(f"to {account} ABCD, not DE88 3704 0044 0532 0130 00")][0] == ("iban", account.replace(" ", ""))
    shown = pii.in_form(account, "iban", pii.surrogate(KEY, "iban", account.replace(" ", ""), 0))
    assert shown != account and [f for *_, f in pii.accounts(shown)] == [shown.replace(" ", "")]
    assert [k for _, _, k, _ in pii.detect("123-45-6789 000-12-3456")] == ["ssn"]


def test_long_local_part_goes_whole(spark):
    local = "abcdefghij" * 8
    out = pii.replace_entities(spark.createDataFrame([(1, f"x {local}@mail.org y")], "doc_id long, text string"), KEY).first()["text"]
    word = out.split()[1]
    assert len(word.split("@")[0]) == 80 and not any(local[k:k + 12] in word for k in range(68))


def test_planted_entities_brute_force(spark):
    """Texts are made of pieces that are known to be entities or not, so no detector is asked."""
    rng = random.Random(5)
    entities = {
        "email": ["bob@mail.org", "Ann.Lee@mail.org", "z_9@a-b.example.net"], "ip": ["10.0.0.1", "8.8.4.4"],
        "phone": ["555-123-4567", "+1 (743) 555-3824"], "iban": ["GB82WEST12345698765432"], "ssn": ["123-45-6789"],
        "card": ["4111 1111 1111 1111", "4111-1111-1111-1112"], "name": ["Mr. Ivan Petrov", "Frau Müller", "Mme Ελένη Παππά", "Mr. 王伟"]}
    form = {"email": r"[\w.+%-]+@[\w.-]+\.[Ee]xample", "ip": r"\d+(\.\d+){3}", "phone": r"(\+1 \(\d{3}\) |\d{3}-)\d{3}-\d{4}", "iban": r"GB\d\d[A-Z]{4}\d{14}",
            "ssn": r"\d{3}-\d\d-\d{4}", "card": r"\d{4}([ -]\d{4}){3}", "name": r"(Mr\.|Frau|Mme) \w+( \w+)?"}
    plain = ["the", "of, and", "12345", "a@b", "3.14", "Mister", "été;", "\n", "«x»"]
    docs = []
    for d in range(60):
        pieces = []
        for _ in range(rng.randint(0, 12)):
            kind = rng.choice([None, *entities])
            pieces.append((kind, rng.choice(entities[kind]) if kind else rng.choice(plain)))
        docs.append((d, pieces))
    df = spark.createDataFrame([(d, " | ".join(x for _, x in p)) for d, p in docs], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.replace_entities(df, KEY).collect()}
    became = {}
    for d, pieces in docs:
        out = got[d]["text"].split(" | ") if pieces else []
        assert len(out) == len(pieces) and got[d]["n_entities"] == sum(k is not None for k, _ in pieces)
        for (kind, old), new in zip(pieces, out):
            if kind is None:
                assert new == old
            else:
                assert re.fullmatch(form[kind], new) and new != old
                assert became.setdefault(old, new) == new
    assert len(set(became.values())) == len(became) and not set(became) & set(became.values())
    real = {x for v in entities.values() for x in v}
    assert not any(e in r["text"] for r in got.values() for e in real)


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = docs.where(F.length("text") > 200).withColumn("h", F.xxhash64("text") % 2)
    pages = held.where("h <> 0").select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"),
                                        F.concat(F.lit("<html><p>"), "text").alias("html"), F.col("lang").alias("truth"))
    found = langid.identify(pages, held.where("h = 0")).join(pages.select("page_id", "truth"), "page_id")
    n, right = found.agg(F.count("*"), F.count_if(F.col("lang") == F.col("truth"))).first()
    assert n > 200 and right / n > 0.97


def test_evidence_is_fused(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["lang"]: r["t"] for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("t")).collect()}
    rows = [(i, f"http://a{i % 4}.fr/x", f"<html lang=fr><p>{texts['fr'][i * 40:i * 40 + 400]}") for i in range(12)]
    rows += [(100 + i, f"http://b{i % 4}.de/x", f"<html lang=de><p>{texts['de'][i * 40:i * 40 + 400]}") for i in range(12)]
    rows += [(200, "http://a1.fr/none", ""), (201, "http://b1.de/none", None), (202, None, None), (203, "http://a1.fr/y", "<html lang='FR'><p>12 34"),
             (203, "http://a1.fr/y", "<html lang='FR'><p>12 34")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, lang string")
    found = langid.identify(df, docs).collect()
    got = {r["page_id"]: r for r in found}
    assert len(found) == len(rows)
    assert all(got[i]["lang"] == "fr" for i in [*range(12), 200, 203]) and all(got[i]["lang"] == "de" for i in [*range(100, 112), 201])
    assert got[202]["lang"] is not None and 0 < got[202]["confidence"] <= 1
    assert langid.identify(df, docs.limit(0)).where("lang is null").count() == len(rows)
    assert langid.identify(df.limit(0), docs).count() == 0


def test_nth_smallest(spark):
    df = spark.range(20000).select(F.xxhash64("id").alias("h")).unionByName(spark.range(20000).select(F.xxhash64("id").alias("h")))
    want = sorted({r["h"] for r in df.collect()})
    assert [langid.nth_smallest(df, "h", n) for n in (1, 50, 4000, 30000)] == [want[0], want[49], want[3999], want[-1]]
    assert langid.nth_smallest(df.limit(0), "h", 5) is None


def test_sample_takes_different_rows_from_all_tasks(spark):
    docs = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.concat(F.lit("text "), F.sha1(F.col("id").cast("string")))).alias("t"),
                                    F.lit("en").alias("l"))
    languages, table = langid.train(docs, "l", "t", 40)
    assert languages == ["en"] and table.shape == (1, langid.BUCKETS)
    plan = docs.withColumn("_h", F.xxhash64("t", "l"))
    last = langid.nth_smallest(plan.select("_h"), "_h", 40)
    assert plan.where(F.col("_h") <= last).select("t").distinct().count() == 40


def brute_fusion(docs, pages):
    """The query's rule, row by row, with every document as training row."""
    counts = defaultdict(lambda: np.zeros(langid.BUCKETS))
    for lang, t in {(r["lang"], r["text"]) for r in docs if r["lang"] is not None and r["text"] is not None}:
        np.add.at(counts[lang], langid.trigrams(t), 1)
    names = sorted(counts)
    table = np.array([counts[x] + langid.SMOOTH for x in names])
    table = np.log(table / table.sum(axis=1, keepdims=True))
    seen = []
    for r in pages:
        x = table[:, langid.trigrams(langid.page_text(r["html"] or ""))].sum(axis=1) * langid.TRIGRAM_WEIGHT
        p = np.exp(x - x.max())
        said = re.search(r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})""", r["html"] or "")
        host = re.split("[/?#]", r["url"].split("://", 1)[1])[0].lower().split(":")[0] if "://" in (r["url"] or "") else ""
        domain = ".".join(host.split(".")[-2:])
        seen.append((r["page_id"], said[1].lower() if said else "", domain.split(".")[-1], domain, host, p / p.sum()))
    mass = sum(s[5] for s in seen) + langid.SMOOTH
    out = []
    for s in seen:
        def others(k):
            if k > 2 and not s[4]:
                return np.zeros(len(names))
            return np.maximum(sum(o[5] for o in seen if o[k] == s[k] and (k < 3 or o[4])) - s[5], 0)

        prior = mass / mass.sum()
        for k, weight in ((3, langid.DOMAIN_WEIGHT), (4, langid.HOST_WEIGHT)):
            prior = (others(k) + weight * prior) / (others(k).sum() + weight)
        score = np.log(s[5] + 1e-12) + np.log(prior)
        for k in (1, 2):
            score = score + np.log((others(k) + langid.SMOOTH) / (mass + 20 * langid.SMOOTH))
        out.append((s[0], s[1], names[int(score.argmax())], 1 / np.exp(score - score.max()).sum(), names[int(s[5].argmax())]))
    return out


def test_query_matches_brute_force(spark):
    docs, pages = (spark.read.parquet(f"{SF}/{t}.parquet").collect() for t in ("documents", "pages"))
    want = {r[0]: r for r in brute_fusion(docs, pages)}
    got = QUERIES["op8_language_id"](spark, SF).collect()
    assert len(got) == len(pages) == len(want)
    for r in got:
        w = want[r["page_id"]]
        assert (r["declared"], r["lang"], r["text_lang"]) == (w[1], w[2], w[4]) and abs(r["confidence"] - w[3]) < 1e-5


def test_fusion_decides_where_there_is_little_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    truth = {r["page_id"]: r["text_lang"] for r in langid.identify(pages, docs).collect()}
    # of every second page only two characters are left of the article, and no title
    short = F.concat(F.regexp_extract("html", "(?s)^(.*?<html[^>]*>)", 1), F.lit("<p>"),
                     F.substring(F.regexp_extract("html", "(?s)<article>.*?<p>(?:<b>)?([^<]*)", 1), 1, 2))
    cut = pages.withColumn("html", F.when(F.col("page_id") % 2 == 0, short).otherwise(F.col("html")))
    found = [r for r in langid.identify(cut, docs).collect() if r["page_id"] % 2 == 0]
    fused, alone = (sum(r[c] == truth[r["page_id"]] for r in found) for c in ("lang", "text_lang"))
    assert fused > alone, (fused, alone, len(found))
