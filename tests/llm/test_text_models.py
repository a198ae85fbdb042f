import math
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.llm import backoff, crf_extract, decontaminate, langid, warc

from .fixtures import corpus, empty, frame

SF = "/root/testdata/sf0.001"


def edit_distance_to_substring(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


@given(st.text("abc", min_size=1, max_size=70), st.text("abcd", max_size=90))
@settings(max_examples=300, deadline=None)
def test_myers_is_the_edit_distance(pattern, text):
    assert decontaminate.myers(pattern, text)[0] == edit_distance_to_substring(pattern, text)


@given(st.text("abcdefgh ", min_size=24, max_size=90), st.lists(st.tuples(st.integers(0, 200), st.sampled_from("sid")), max_size=6), st.text("abcdefgh ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_decontamination_against_all_places(item, edits, around):
    copy = list(item)
    for at, kind in edits:
        at %= max(1, len(copy))
        copy[at : at + (kind != "i")] = [] if kind == "d" else ["h"]
    document = around + " " + "".join(copy) + " " + around
    matcher = decontaminate.Matcher([(7, item)], errors=0.1)
    found = list(matcher.find(document))
    if not matcher.items:
        assert not found
        return
    if matcher.items[0][2] < 0:  # a short item: exactly, as whole words
        assert bool(found) == (f" {decontaminate.normalise(item)} " in f" {decontaminate.normalise(document)} ")
        return
    want = edit_distance_to_substring(decontaminate.normalise(item), decontaminate.normalise(document))
    assert bool(found) == (want <= matcher.items[0][2])


def test_decontamination_rows_and_blocks(spark):
    item = "The quick brown fox jumps over the lazy dog near the river bank"
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short"), (1, item), (9, "Another item that is long enough to be tested here.")], "item_id long, text string")
    rows = [(1, f"x {item.upper()} y"), (2, None), (3, ""), (4, "w " * 20000 + item.replace("quick", "quack")), (5, "clean text"), (None, item), (1, f"x {item.upper()} y")]
    docs = frame(spark, rows)
    for block in (decontaminate.BLOCK_CHARS, 40):
        got = sorted((tuple(r)[:3] for r in decontaminate.matches(docs, items, block_chars=block).distinct().collect()), key=repr)
        assert got == [(1, 1, 0), (4, 1, 1), (None, 1, 0)]
        left = docs.where(~decontaminate.contaminated(F.col("text"), items, block_chars=block))
        assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 5]
    assert decontaminate.matches(empty(spark), items).collect() == []
    assert decontaminate.matches(docs, items.limit(0)).collect() == []


def test_short_items_and_items_without_an_id(spark):
    items = spark.createDataFrame([(1, "Forty-two"), (None, "the answer is"), (None, "the answer is"), (3, " ?! "), (None, "a longer item of the benchmark without an id"), (4, None)], "item_id long, text string")
    docs = frame(spark, [(1, "It is forty two."), (2, "forty twofold"), (3, "THE  ANSWER\nis: a longer item of the benchmurk without an id"), (4, None), (5, "!?")])
    found = sorted(((r["doc_id"], r["item_id"], r["distance"], r["error_budget"], r["match_start"], r["match_end"]) for r in decontaminate.matches(docs, items).collect()), key=repr)
    assert found == [(1, 1, 0, 0, 6, 15), (3, None, 0, 0, 0, 13), (3, None, 0, 0, 0, 13), (3, None, 1, 2, 14, 58)]
    kept = docs.where(~decontaminate.contaminated(F.col("text"), items)).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == [2, 4, 5]


def test_warc_derivatives_and_files(spark, tmp_path):
    pages = [(1, "http://a/", "<html><head><title>T &amp; x</title><script>no</script></head><body><p>One &copy;<br>two</p><a href='/l'>link</a></body>"), (2, None, None), (3, "http://b/", ""),
             (4, "http://c/", "WARC/1.1\r\n\r\nplain é " * 3000), (None, "http://d/", "<p>x"), (1, "http://a/", "<p>again")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("header", F.lit("clash")).withColumn("payload", F.lit("clash"))
    source = warc.responses(table)
    records = warc.derivatives(source)
    rows = records.collect()
    assert len(rows) == 12
    ids = {r["record_id"]: r for r in source.collect()}
    for r in rows:
        origin = ids[r["refers_to"]]
        assert r["payload_digest"] == warc.digest((origin["payload"] or "").encode()) and r["target_uri"] == origin["target_uri"]
        assert r["block_digest"] == warc.digest(r["block"].encode()) and r["content_length"] == len(r["block"].encode())
    first = next(r for r in rows if r["warc_type"] == "conversion" and r["block"].startswith("T & x"))
    assert first["block"] == "T & x\nOne ©\ntwo\nlink"
    meta = next(r for r in rows if r["warc_type"] == "metadata" and r["refers_to"] == first["refers_to"])
    assert "title: T & x\r\n" in meta["block"] and "outlink: /l\r\n" in meta["block"] and "source-http: HTTP/1.1 200 OK\r\n" in meta["block"]
    warc.write_warc(records, str(tmp_path / "out"), records_per_file=5)
    back = warc.read_warc(spark, str(tmp_path / "out")).collect()
    assert sorted((b["fields"]["WARC-Record-ID"], bytes(b["block"])) for b in back) == sorted((r["record_id"], r["block"].encode()) for r in rows)
    assert all(b["fields"]["WARC-Refers-To"] in ids for b in back)
    assert warc.derivatives(warc.responses(table.limit(0))).collect() == []


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.fit(docs.where(~held))
    rows = langid.predicted(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_odd_rows(spark):
    rows = [(i, "the and of that with this " * 3, "en") for i in range(20)] + [(i + 50, "der die das und nicht ein " * 3, "de") for i in range(20)]
    odd = [(100, None, "en"), (101, "", "en"), (102, "123 !!", None), (103, "der und die " * 30000, None), (None, "the of and", None), (104, "x", None), (100, None, "en")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("key", F.lit(1)).withColumn("features", F.lit(1))
    model = langid.fit(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predicted(docs, model).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103][0] == "de" and got[None][0] == "en" and got[104][0] in ("de", "en")
    kept = docs.where(langid.accepted(F.col("text"), model, spark))
    assert kept.columns == docs.columns and {100, 101, 102}.isdisjoint(r["doc_id"] for r in kept.collect())
    none = langid.fit(docs.where("false"))
    assert {r["lang_pred"] for r in langid.predicted(docs, none).collect()} == {"und"}
    assert langid.predicted(empty(spark), model).collect() == []


def test_features_are_the_ngrams():
    # the counts of hashed n-grams of a text are those of its letters-and-spaces form
    a, b = langid.counts("Ab  c!!d"), langid.counts("ab c d")
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])
    assert a[1].sum() == 8 + 7 + 6  # of " ab c d "


def test_follow_the_leader_is_sparse_and_separates():
    rng = np.random.default_rng(0)
    rows = [(np.array([y, *(2 + rng.choice(50, 3, False))]), np.array([1.0, 0.1, 0.1, 0.1]), y) for y in rng.integers(0, 2, 400)]
    row, w = langid.follow_the_leader(rows, 2)
    assert w[row[0], 0] > w[row[0], 1] and w[row[1], 1] > w[row[1], 0] and not w[-1].any()
    assert (w[row[:52]] == 0).mean() > 0.5 and (row[52:] == len(w) - 1).all()  # of the seen features


def test_follow_the_leader_step_by_step():
    """The same weights as the update rule written out for single numbers."""
    pick = random.Random(2)
    rows = [(np.array(sorted(pick.sample(range(9), 3))), np.array([pick.uniform(0.2, 1) for _ in range(3)]), pick.randrange(3)) for _ in range(60)]
    z, n = [[0.0] * 3 for _ in range(9)], [[0.0] * 3 for _ in range(9)]

    def weight(f, c):
        if abs(z[f][c]) <= langid.L1:
            return 0.0
        return -(z[f][c] - math.copysign(langid.L1, z[f][c])) / ((langid.BETA + math.sqrt(n[f][c])) / langid.ALPHA + langid.L2)

    for _ in range(langid.EPOCHS):
        for at, value, label in rows:
            w = {(f, c): weight(f, c) for f in at for c in range(3)}
            logit = [sum(v * w[f, c] for f, v in zip(at, value, strict=True)) for c in range(3)]
            total = sum(map(math.exp, logit))
            for f, v in zip(at, value, strict=True):
                for c in range(3):
                    g = v * (math.exp(logit[c]) / total - (c == label))
                    z[f][c] += g - (math.sqrt(n[f][c] + g * g) - math.sqrt(n[f][c])) / langid.ALPHA * w[f, c]
                    n[f][c] += g * g
    row, weights = langid.follow_the_leader(rows, 3)
    assert np.allclose(weights[row[:9]], [[weight(f, c) for c in range(3)] for f in range(9)])


def test_every_label_can_be_predicted(spark):
    pick = random.Random(3)
    word = lambda k: "".join(chr(0x4E00 + 3 * k + pick.randrange(3)) for _ in range(6))
    rows = [(k * 1000 + i, " ".join(word(k) for _ in range(30)), f"l{k:02d}") for k in range(70) for i in range(16 if k else 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(docs)
    assert len(model.languages) == 70
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predicted(docs, model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) > 0.95 * len(rows) and len(set(got.values())) == 70


def pages_table(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


def test_extraction_is_the_article(spark):
    import html

    pages = pages_table(spark)
    model = crf_extract.fit(pages, sample=60)
    right = total = 0
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in crf_extract.extracted(pages, model).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", source[r["page_id"]], re.S)[1]
        right += r["text"] == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
        total += 1
        assert r["n_chars"] == len(r["text"])
    assert right / total >= 0.97


def test_extraction_of_other_layouts_and_odd_pages(spark):
    rows = [r["html"] for r in pages_table(spark).limit(80).collect()]
    model = crf_extract.train(crf_extract.labelled(rows[:35]))
    tested = crf_extract.labelled(rows[35:], layouts=4)
    pairs = [(a, b) for chain, labels in tested for a, b in zip(model.decode(chain), labels, strict=True)]
    assert sum(a == b for a, b in pairs) / len(pairs) >= 0.98
    odd = [(1, "u", None), (2, None, ""), (3, "u", "<p>x"), (None, "u", "<<>>&#x110000;&bogus;<a href='>'>"), (4, "u", "<article><p>" + "long text. " * 30000), (4, "u", "<!-- open")]
    docs = spark.createDataFrame(odd, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("key", F.lit("clash"))
    got = crf_extract.extracted(docs, model).collect()
    assert len(got) == 6 and {r["text"] for r in got if r["page_id"] in (1, 2)} == {""}
    assert crf_extract.extracted(docs.limit(0), crf_extract.fit(docs.limit(0))).collect() == []


def test_viterbi_and_marginals_against_all_labellings():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5):
        rows = [[f"f{i}"] for i in range(n)]
        model = crf_extract.Field({f"f{i}": rng.normal(size=2) for i in range(n)}, rng.normal(size=(2, 2)), rng.normal(size=2))
        s = model.scores(rows)

        def score(y, s=s, model=model):
            return model.begin[y[0]] + sum(s[i, y[i]] for i in range(len(y))) + sum(model.turn[a, b] for a, b in zip(y, y[1:], strict=False))

        every = list(product((0, 1), repeat=n))
        assert tuple(model.decode(rows)) == max(every, key=score)
        weights = np.exp([score(y) for y in every])
        single, pair = model.marginals(s)
        for i in range(n):
            assert single[i, 1] == pytest.approx(sum(w for w, y in zip(weights, every, strict=True) if y[i]) / weights.sum())
        assert pair.sum() == pytest.approx(n - 1)


def toks(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def test_tokens_are_the_words(monkeypatch):
    texts = [(t or "").encode() for _, t in corpus(4, 60)] + ["A a\x0bÉ\x1cé\u00a0x".encode(), b"x" * 5000 + b" y", b" \n", b"ab ba abab baba"]
    whole = backoff.tokens(texts)
    monkeypatch.setattr(backoff, "SLICE", 64)  # the same in slices, and with long texts cut
    for h, lengths in (whole, backoff.tokens(texts)):
        words = [toks(t.decode()) for t in texts]
        assert lengths.tolist() == [len(w) for w in words]
        seen = {}
        assert all(seen.setdefault(w, x) == x for w, x in zip((w for ws in words for w in ws), h.tolist(), strict=True))
        assert len(set(seen.values())) == len(seen) > 400
    assert backoff.tokens([])[0].tolist() == []


def brute_model(texts, order=3):
    """The model's probability function p(word, history), from plain counts."""
    lists = [toks(t) for t in texts]
    n = [Counter(tuple(x[i : i + k]) for x in lists for i in range(len(x) - k + 1)) for k in (1, 2, 3)]
    total, distinct = sum(n[0].values()), len(n[0])
    two, three = n[1], n[2] if order > 2 else {}

    def one(w):
        return (n[0][(w,)] + 1) / (total + distinct + 1)

    def p(w, history):
        h = tuple(history[-2:])
        if len(h) == 2:
            going = [k for k in three if k[:2] == h]
            if (*h, w) in three:
                return (three[(*h, w)] - backoff.DISCOUNT) / two[h]
            if going:
                left = 1 - sum((three[k] - backoff.DISCOUNT) / two[h] for k in going)
                return left / (1 - sum(p(k[2], h[1:]) for k in going)) * p(w, h[1:])
            return p(w, h[1:])
        if len(h) == 1:
            going = [k for k in two if k[0] == h[0]]
            if (*h, w) in two:
                return (two[(*h, w)] - backoff.DISCOUNT) / n[0][h]
            if going:
                left = 1 - sum((two[k] - backoff.DISCOUNT) / n[0][h] for k in going)
                return left / (1 - sum(one(k[1]) for k in going)) * one(w)
        return one(w)

    return p, one, n[0], total


@pytest.mark.parametrize("blocks", [1 << 10, 1 << 30])
def test_scores_are_the_models_probabilities(spark, blocks):
    import zlib

    rows = [(i, re.sub("w(.)..?", r"w\1", t) if t else t) for i, t in corpus(9, 60)]
    learn = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    p, one, counts, total = brute_model(learn)
    got = backoff.scored(frame(spark, rows), block_bytes=blocks).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        x = toks(t)
        want.append((i, len(x), sum(counts[(w,)] > 0 for w in x), sum(math.log10(one(w)) for w in x), sum(math.log10(p(w, x[max(0, k - 2) : k])) for k, w in enumerate(x))))
    key = lambda r: (repr(r[0]), r[1], round(r[3], 6))
    for a, r in zip(sorted(want, key=key), sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got), key=key), strict=True):
        assert a[:3] == r[:3] and r[3] == pytest.approx(a[3]) and r[4] == pytest.approx(a[4])
    assert {r["train_tokens"] for r in got} == {total}
    # every history's probabilities sum to one: over the known words and the unknown one
    for h in ([], [("The")], ["of", "the"], ["the"]):
        assert sum(p(w[0], h) for w in counts) + p("never seen", h) == pytest.approx(1)


def test_scores_on_held_out_text_beat_the_base(spark):
    rows = backoff.scored(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert backoff.scored(empty(spark)).collect() == []


def test_the_model_keeps_rare_ngrams_of_a_large_corpus(spark):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 7 != 2]
    new = next(i for i in range(300) if zlib.crc32(str(i).encode()) % 7 == 2)
    rare = [(ids[0], "rare pair here"), (ids[1], "rare pair here"), (ids[2], "sole one"), (new, "rare pair here"), (new, "sole one"), (new, "rare pair new")]
    for filler in (0, 200):  # 0 and 1.0 million tokens
        rows = rare + [(i, "much more text " * 1700) for i in ids[3 : 3 + filler]]
        got = [r for r in backoff.scored(frame(spark, rows)).collect() if r["doc_id"] == new]
        total, distinct = got[0]["train_tokens"], 9 if filler else 6
        assert total == 11 + filler * 5101
        one = {w: (n + 1) / (total + distinct + 1) for w, n in (("rare", 2), ("sole", 1), ("end", 3 + filler), ("here", 2), ("new", 0))}
        two, single, d = 1.25 / 2, 0.25, backoff.DISCOUNT
        to_pair = (1 - two) / (1 - two)  # "rare pair" and "pair" both go on with "here" only
        unseen = to_pair * (1 - two) / (1 - one["here"]) * one["new"]
        want = [one["rare"] * two**3, one["sole"] * single**2, one["rare"] * two * unseen * one["end"]]
        assert sorted(r["score"] for r in got) == pytest.approx(sorted(math.log10(x) for x in want)) and d == 0.75


def test_the_model_grows_with_the_table(spark):
    kept = []
    for sf in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        blocked = docs.select(F.col("doc_id") % 16, ~backoff.held_out(F.col("doc_id")), F.coalesce("text", F.lit("")).cast("binary")).toDF("block", "learn", "text")
        orders = backoff.ngram_counts(blocked, 4).groupBy(F.shiftright("bucket", 4).alias("order")).agg(F.sum("distinct")).collect()
        kept.append([n for _, n in sorted(orders)])
    assert len(kept[0]) == 3 and all(b > 2 * a for a, b in zip(*kept, strict=True))


def test_scores_do_not_depend_on_the_blocks(spark):
    # in one block every n-gram is its own; in many the buckets answer
    docs, before = frame(spark, corpus(9, 60)), spark.conf.get("spark.sql.shuffle.partitions")
    got = [sorted((tuple(r) for r in backoff.scored(docs, block_bytes=1 << 10).collect()), key=repr)]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got.append(sorted((tuple(r) for r in backoff.scored(docs).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got[0]) == len(got[1]) == docs.count()
    for a, b in zip(*got, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_digits_of_a_block_are_those_of_all_its_text():
    long = "a" * 500 + "1" * 1500
    own, early = (set(crf_extract.features([crf_extract.Block(t, (), 0)])[0]) for t in (long, "1" * 400 + "a" * 6000))
    assert "digits2" in own and "digits0" in early


@pytest.mark.parametrize("first", ["<body><p>", "<p>", "<body>", "<a href='/'>", "<img src='x'>"])
def test_a_head_left_open_ends_at_the_body(first):
    page = f"<html><head><meta charset='utf-8'><title>no</title><script>no</script><link rel='x'><style>no</style>{first}Text"
    assert [(b.text, any(s[0] == "head" for s in b.above)) for b in crf_extract.leaf_blocks(page)] == [("Text", False)]


def test_extraction_learns_without_short_labelled_pages(spark):
    body = "".join(f"<p>{'Some words of the long main text. ' * 12}</p>" for _ in range(4))
    for markup, times in (("div id='content'", 1), ("article", 80)):
        tag = markup.split()[0]
        page = f"<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><{markup}>{body * times}</{tag}><footer><p>Contact</p></footer></body></html>"
        docs = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
        got = crf_extract.extracted(docs, crf_extract.fit(docs)).collect()[0]["text"]
        assert got.startswith("Some words") and got.endswith("main text.") and got.count("Some words") == 48 * times
