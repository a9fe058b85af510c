"""Each operator against a brute-force version, a round trip or planted cases,
with nulls, empty and long texts, ties, repeated rows, empty tables and further
columns whose names clash with results."""

import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hopscope.llm import chat, decontaminate, html_extract, mixture, order_minhash, quality, rans, rules, toxicity, warc
from hopscope.llm.queries import fold, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, h string"


def words(n, seed=0, size=900):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def docs_df(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 0.5, "x") for i, t, s in rows], DOCS)


ODD = [(1, None, "a"), (2, "", None), (3, "one", "a"), (3, "one", "a"), (None, "two words", "b"), (4, " \t\n ", "b"), (5, "x" * 50_000, "a")]


def test_chat_round_trip(spark):
    rows = [(1, 2, "user", "<|text|> a <|end|>"), (1, 1, "user", None), (1, 3, "assistant", "</s>[INST] ok [/INST] <\\|x"), (1, 4, "assistant", "é\n"), (None, 0, None, "n"), (2, 0, "user", ""), (2, 0, "user", "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = chat.format_chats(df, chunk=2).withColumn("t", chat.read_turns(F.col("formatted"))).withColumn("l", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    by = {r["conv_id"]: r for r in got.collect()}
    assert [tuple(t) for t in by[1]["t"]] == [("user", ""), ("user", rows[0][3]), ("assistant", rows[2][3]), ("assistant", "é\n")]
    assert by[1]["l"] == rows[2][3] + "é\n" and by[1]["n_messages"] == 2 and by[2]["n_messages"] == 1 and len(by[2]["t"]) == 2
    assert [tuple(t) for t in by[None]["t"]] == [("", "n")]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_ties_sort_by_the_text_itself(spark):
    rows = [(1, 0, "user", t) for t in ("<|a", "<b", "<\\|a", None, "<<", "")]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    texts = [t["text"] for t in got.select(chat.read_turns(F.col("formatted")).alias("t")).first()["t"]]
    assert texts == sorted(t or "" for *_, t in rows)


def edits_within(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks_match_brute_force(spark):
    rng = random.Random(3)
    bench = [(i, " ".join(words(18, i))) for i in range(4)] + [(9, "tiny"), (10, None), (11, "")]
    rows = []
    for i in range(30):
        body = words(60, 100 + i)
        if i % 3 == 0:
            leak = list(bench[i % 4][1])
            for _ in range(i % 8):
                leak[rng.randrange(len(leak))] = rng.choice("abc")
            body.insert(20, "".join(leak).upper())
        rows.append((i, " \n".join(body), "s"))
    rows += [(30, "a  TINY thing", "s"), *ODD]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs_df(spark, rows), spark.createDataFrame(bench, "item_id long, text string"), block_chars=200).collect()}
    want = set()
    for d, t, _ in rows:
        for item, b in bench:
            for s in decontaminate.segments(decontaminate.normalise(b)):
                budget = min(int(decontaminate.BUDGET * len(s)), max(0, (len(s) - decontaminate.Q) // decontaminate.Q))
                if len(t or "") < 5000 and edits_within(s, decontaminate.normalise(t)) <= budget:
                    want.add((d, item))
    assert got == want and len(want) > 5
    clean = decontaminate.decontaminate(docs_df(spark, rows), spark.createDataFrame(bench, "item_id long, text string"))
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _, _ in rows} - {d for d, _ in want} and clean.columns == docs_df(spark, ODD).columns
    assert decontaminate.leaks(docs_df(spark, rows), spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert decontaminate.leaks(docs_df(spark, ODD).limit(0), spark.createDataFrame(bench, "item_id long, text string")).count() == 0


def test_clean_texts_without_an_id_stay_beside_leaking_ones(spark):
    item = " ".join(words(18, 1))
    leaking = f"before {item} behind"
    rows = [(None, leaking, "s"), (None, leaking, "s"), (None, "a clean text", "s"), (None, "a clean text", "s"), (None, None, "s"), (None, "", "s"), (2, leaking.upper(), "s"), (3, "", "s"), (4, None, "s")]
    clean = decontaminate.decontaminate(docs_df(spark, rows), spark.createDataFrame([(5, item), (6, item + " é")], "item_id long, text string"), block_chars=10)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in clean.collect()) == [(0, ""), (0, ""), (0, "a clean text"), (0, "a clean text"), (3, ""), (4, "")]


def test_leaks_do_not_depend_on_pieces_and_stretches(monkeypatch):
    rng = random.Random(11)
    items = [(i, " ".join(words(14 + 9 * i, i))) for i in range(5)] + [(7, "ab" * 90), (8, "a" * 128), (9, "z" * 400)]
    bodies = []
    for i in range(40):
        body = " ".join(words(300, 50 + i))
        for _, item in rng.sample(items, 3):
            at = rng.randrange(len(body))
            body = body[:at] + item[: rng.choice([80, 400])].replace("e", "o", rng.randrange(4)) + body[at:]
        bodies.append(body)
    index = decontaminate.Index(items)
    whole = [index.matches(b) for b in bodies]
    assert sum(map(bool, whole)) > 20
    for piece, entries in ((1 << 20, 1), (1 << 20, 3000), (700, 1 << 19), (37, 50)):
        monkeypatch.setattr(decontaminate, "PIECE", piece)
        monkeypatch.setattr(decontaminate, "ENTRIES", entries)
        assert [index.matches(b) for b in bodies] == whole


def test_a_repeated_gram_takes_bounded_memory():
    import tracemalloc

    index = decontaminate.Index([(1, "a" * 128), (2, "b" * 300)])
    tracemalloc.start()
    found = index.matches("a" * 20_000 + "b" * 5_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {f[0] for f in found if f[1] == 0} == {1, 2}
    assert peak < 150 << 20


def test_documents_may_have_any_other_columns(spark):
    item = " ".join(words(18, 1))
    docs = spark.createDataFrame([(1, f"x {item}", 5, "k"), (2, "clean", 6, None)], "doc_id long, text string, leaked long, leaked_fp string")
    clean = decontaminate.decontaminate(docs, spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert [tuple(r) for r in clean.collect()] == [(2, "clean", 6, None)]


def test_swapped_identity_terms_lose_weight():
    rng = random.Random(5)
    texts, y = [], []
    for i in range(400):
        bad = i % 2
        body = words(10, i) + (["idiot"] if bad else []) + (["muslim"] if rng.random() < (0.8 if bad else 0.1) else ["hindu"] if rng.random() < 0.3 else [])
        texts.append(" ".join(body))
        y.append(bad)
    of = toxicity.Features()
    rows = [np.array(sorted(of(t)), np.int64) for t in texts]
    copies = [None if (s := toxicity.swapped(t)) is None else np.array(sorted(of(s)), np.int64) for t in texts]
    gap = []
    for penalty in (0.0, 30.0):
        w, _ = toxicity.fit(rows, copies, np.array(y, float), 0.5, penalty)
        gap.append(abs(w[list(of("muslim"))].sum() - w[list(of(toxicity.SWAP["muslim"]))].sum()))
    assert gap[1] < 0.5 * gap[0]
    assert toxicity.swapped("No group here.") is None and toxicity.swapped("A Muslim man.") == "A christian girl."


def test_classifiers_on_held_out_rows(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, " ".join(words(40, i) + (["idiot"] * 1 if bad else [])) if i % 2 else " ".join(w.upper() + "!!" if bad else w for w in words(40, i)) + (" idiot" if bad else ""), "s"))
        labels.append((i, int(not bad), int(bad)))
    labels += [(None, 1, None), (7, 1, 0)]
    df, lab = docs_df(spark, rows + ODD), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for module, label, k, flip in ((toxicity, "toxic", 5, False), (quality, "quality", 3, True)):
        model = module.train(df, lab, train_rows=fold(F.col("__id"), k) != 1)
        got = module.score(df, model).collect()
        assert len(got) == len(rows) + len(ODD) and set(got[0].asDict()) == set(df.columns)
        held = [r for r in got if r["doc_id"] is not None and r["doc_id"] > 5 and zlib.crc32(str(r["doc_id"]).encode()) % k == 1]
        right = sum((r["score"] >= 0.5) == ((r["doc_id"] % 4 == 0) != flip) for r in held)
        assert right > 0.9 * len(held)
        assert all(0 <= r["score"] <= 1 for r in got)
        again = module.train(df.repartition(3), lab.repartition(2), train_rows=fold(F.col("__id"), k) != 1)
        assert np.array_equal(model[0], again[0]) and model[1] == again[1]
        assert module.score(df.limit(0), model).count() == 0
        module.score(df, module.train(df, lab.limit(0))).collect()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site<h1>Brand</h1></header><nav><ul><li><a href="/a">Menu one</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
%s<aside>Side, bar.</aside><form>Your mail: <input></form><div id="comments"><p>First! A reader, commenting.</p></div>
<footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<div class='content'>%s</div>", "<main><section>%s</section></main>"])
def test_main_text(spark, wrap):
    body = "<h1>A &amp; B</h1><p><b>One,  two\n three.<br><p>Four &lt;five&gt; &eacute;, six. <a href=x>seven</a>.</p><div class=ad>Buy, now!</div><ul><li>i<li>j</ul>"
    df = spark.createDataFrame([(1, "u", PAGE % (wrap % body), "clash"), (2, None, None, "c"), (3, "u", "", "c"), (3, "u", "plain", "c")], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"]) for r in html_extract.extract(df).orderBy("page_id", "text").collect()]
    assert got == [(1, "A & B\nOne, two three.\nFour <five> é, six. seven.\ni\nj"), (2, ""), (3, ""), (3, "plain")]
    assert html_extract.extract(df.limit(0)).count() == 0


NAMED = ["<div class='layout has-sidebar'>%s</div>", "<div class='content no-sidebar'>%s</div>", "<div class='wrapper with-footer'>%s</div>", "<div id='search-results'>%s</div>",
         "<div class='elementor-widget elementor-widget-text-editor'>%s</div>", "<div class='legal-notice'>%s</div>", "<div class='social-page'>%s</div>"]


@pytest.mark.parametrize("wrap", [*NAMED, *(w % "<article>%s</article>" for w in NAMED), "<article><div class='article-header'>%s</div></article>"])
def test_names_of_wrappers_do_not_drop_content(wrap):
    body = "<h1>Of names</h1><p>One sentence, of some length, is here.</p><div class=ad>Buy, now!</div><p>And another one, <span class='comment-ref'>longer</span> than that.</p>"
    want = "Of names\nOne sentence, of some length, is here.\nAnd another one, longer than that."
    assert html_extract.main_text(PAGE % (wrap % body)) == want


def test_named_parts_of_articles():
    page = "<article><div class='article-header'><h1>Title</h1></div><p>One sentence, of some length, is here; and more.</p><p class='legal-text'>The law, as it is.</p><div class='post-sidebar'>Also, this.</div></article>"
    comments = "<div class='comments'>%s</div>" % ("<article><p>First! A reader, commenting at length, as they do.</p></article>" * 2)
    want = "Title\nOne sentence, of some length, is here; and more.\nThe law, as it is."
    assert html_extract.main_text(PAGE % page) == html_extract.main_text(PAGE % (page + comments)) == want
    parts = "".join(f"<div class='elementor-widget elementor-widget-text-editor'><p>Part {i}, of some length, is here.</p></div>" for i in range(5))
    assert html_extract.main_text(PAGE % parts) == "\n".join(f"Part {i}, of some length, is here." for i in range(5))


@pytest.mark.parametrize("around", ["%s", "<div class='content'>%s</div>"])
def test_all_articles_without_their_link_lists(around):
    links = "<ul>%s</ul>" % "".join(f"<li><a href='/{i}'>Another page, number {i}</a></li>" for i in range(4))
    one = "<article><h2><a href='/1'>One</a></h2><p>The first text, of some length, is here; it goes on.</p>%s</article>"
    two = "<article class='b'><h2>Two</h2><p>The second, shorter.</p><ul><li>plain<li>items</ul>%s</article>"
    teaser = "<article class='c'><h3><a href='/3'>Only a link</a></h3></article>"
    want = "One\nThe first text, of some length, is here; it goes on.\nTwo\nThe second, shorter.\nplain\nitems"
    assert html_extract.main_text(PAGE % (around % (one % links + two % links + teaser))) == want
    assert html_extract.main_text(PAGE % (around % ("<main>" + one % links + two % links + "</main>"))) == want
    assert html_extract.main_text("<ul><li><a href=x>Only</a><li><a href=y>links</a></ul>") == "Only\nlinks"


def test_warc_round_trip(spark):
    rows = [(1, "http://a/é", "same"), (7, None, "same"), (5, "u", "same"), (2, "u", None), (3, "u", ""), (None, "u", "solo"), (9, "u", "é" * 100_000), (9, "u", "é" * 100_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha string")
    got = sorted(((r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc.archived(df).collect()), key=str)
    digest = lambda t: warc.base32_sha1((t or "").encode())
    want = [(1, "revisit", 7, 4, digest("same")), (7, "response", None, 4, digest("same")), (5, "revisit", 7, 4, digest("same")), (2, "revisit", 3, 0, digest("")), (3, "response", None, 0, digest("")), (-1, "response", None, 4, digest("solo")), *[(9, "response", None, 200_000, digest("é" * 100_000))] * 2]
    assert got == sorted(want, key=str)
    assert all(r["record_type"] == "response" for r in warc.read_archives(warc.write_archives(df, _path(spark), min_bytes=300_000)).collect())
    assert warc.archived(df.limit(0)).count() == 0


def _path(spark):
    from hopscope.llm.common import fresh_path

    return fresh_path(spark, "test")


def test_warc_reader_finds_damage():
    good = warc.record(1, "u", b"payload", None) + warc.record(2, "u", b"payload", (1,))
    assert [r[0]["warc-type"] for r in warc.records(io.BytesIO(good))] == ["response", "revisit"]
    with pytest.raises((warc.WarcError, zlib.error)):
        list(warc.records(io.BytesIO(good[:-5])))
    bad = zlib.compressobj(5, zlib.DEFLATED, 31)
    text = zlib.decompress(warc.record(1, "u", b"payload", None), 31).replace(b"payload\r\n", b"payl0ad\r\n")
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(bad.compress(text) + bad.flush())))


def test_rules(spark):
    texts = ["a b c a b c d", "x y z", "", None, "l1\nl1\n \n \nl2 #*", " ".join(words(300, 1, 8)), " ".join(words(200)), "A! " * 80, "q " * 100_000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, kept string")
    t = F.coalesce("text", F.lit(""))
    got = df.select("doc_id", rules.n_words(t), rules.word_chars(t), rules.n_symbols(t), rules.n_dup_lines(t), rules.n_repeat_words(t)).collect()
    for r, text in zip(got, texts, strict=True):
        w = (text or "").encode().split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        seen = {}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
        covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if x.split()]
        assert tuple(r)[1:] == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
    verdicts = [r["passed"] for r in rules.judge(df, verdict="passed").orderBy("doc_id").collect()]
    assert verdicts[6] and not any(verdicts[i] for i in (0, 1, 2, 3, 4, 5, 7, 8))
    assert rules.judge(df.limit(0), verdict="passed").count() == 0
    ordered = rules.order(rules.RULES[:2], [(rules.RULES[0].name, 1.0, 0.1), (rules.RULES[1].name, 0.1, 0.1)])
    assert [r.name for r in ordered] == ["symbols", "few_words_or_repeats"]


def test_rans_blocks():
    rng = np.random.default_rng(1)
    for n, vocabulary in ((1, 5), (700, 1), (5000, 3), (70_000, 40_000)):
        ids = (rng.zipf(1.3, n) % vocabulary).astype(np.uint16)
        data = rans.encode_file([1, None], [n - n // 2, n // 2], ids, block_tokens=1000, max_lanes=7)
        reader = rans.Reader(data)
        assert np.array_equal(np.concatenate([reader.block(i) for i in range(len(reader.head["blocks"]))]), ids)
        assert np.array_equal(reader.block(0), ids[:1000])  # any block alone
        assert [(d, len(x)) for d, x in reader.documents()] == [(1, n - n // 2), (None, n // 2)]
    broken = bytearray(data)
    broken[-3] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.Reader(bytes(broken)).block(len(reader.head["blocks"]) - 1)


def test_words_are_encoded_as_whole_texts_are():
    tokens = rans.Tokens(tokenizer_path())
    bits = ["a", "B", "7", " ", "  ", "\n", ".", "'s", "'", "é", "\t", "<|endoftext|>", "-", "ß", "\x1c", "it's", "\r\n", "", " the", "\u3000", "好"]
    rng = np.random.default_rng(3)
    texts = ["".join(bits[i] for i in rng.integers(0, len(bits), rng.integers(0, 15))) for _ in range(5000)]
    tokens.KEPT = 500  # the kept words are cut back in between
    got = [x for lo in range(0, len(texts), 100) for x in tokens.encode(texts[lo : lo + 100])]
    want = tokens.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, tokens.dtype).tolist() for x in got] == [e.ids for e in want]


def test_token_files(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    rows = [(i, " ".join(words(30, i)) + "  two\n three ", "s") for i in range(49, 9, -1)] + ODD
    got = rans.token_files(docs_df(spark, rows), tokenizer_path(), file_tokens=500, partitions=3).orderBy("start").collect()
    at = 0
    key = lambda r: (r[0] is not None, r[0] or 0)
    for r, (doc, text, _) in zip(got, sorted(rows, key=key), strict=True):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert tuple(r) == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert rans.token_files(docs_df(spark, ODD).limit(0), tokenizer_path()).count() == 0


def test_mixture(spark):
    rows = [(i, " ".join(words(5 + i % 40, i)), "abcd"[i % 4] if i % 2 else "a") for i in range(800)] + ODD + [(900, "n " * 200, None)]
    df = docs_df(spark, rows)
    out = mixture.plan_mix(df, shard_words=3000)
    got = out.select("doc_id", "source", "__size", "__target", F.size("__shards").alias("n")).collect()
    size, taken, target = {}, {}, {}
    for r in got:
        size[r["source"]] = size.get(r["source"], 0) + r["__size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["__size"] * r["n"]
        target[r["source"]] = r["__target"]
        assert r["n"] <= 3 and (r["__size"] > 0 or r["n"] == 0)
    order = sorted(size, key=lambda s: (s is None, s))
    weight, capped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in capped)
        want = {s: 3 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in order if x not in capped) for s in order}
        over = {s for s in order if want[s] > 3 * size[s] * (1 + 1e-12)} - capped
        if not over:
            break
        capped |= over
    assert all(abs(target[s] - want[s]) < 1e-6 * (1 + want[s]) for s in order)
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 5 or s is None for s in order)
    mixed = mixture.mix(df, "shard", shard_words=3000)
    assert mixed.columns == [*df.columns, "shard"] and mixed.count() == sum(r["n"] for r in got)
    loads = [r["count"] for r in mixed.groupBy("shard").agg(F.sum(F.size(F.split("text", " "))).alias("count")).collect()]
    assert len(loads) > 4 and max(loads) < 2 * sum(loads) / len(loads)
    pick = lambda d: sorted((r["doc_id"] or -1, r["__shards"]) for r in mixture.plan_mix(d, shard_words=3000).collect())
    assert pick(df) == pick(df.repartition(5))
    assert mixture.plan_mix(df.limit(0)).count() == 0 and mixture.mix(df.limit(0)).count() == 0


def plain_matches(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_banded_matches():
    rng = random.Random(2)
    for _ in range(1000):
        a = rng.sample(range(30), rng.randrange(1, 15))
        b = [c for c in a if rng.random() < 0.8]
        for _ in range(rng.randrange(4)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(30, 60))
        if rng.random() < 0.3:
            rng.shuffle(b)
        b = list(dict.fromkeys(b))
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        assert order_minhash.banded_matches(x, y, 100) == plain_matches(a, b)
        need = -(-8 * max(len(a), len(b)) // 10)
        assert order_minhash.same(x, y) == (plain_matches(a, b) >= need)


def test_sketches_pass_what_is_near():
    rng, n, passed = np.random.default_rng(5), 400, 0
    for _ in range(300):
        both = rng.integers(0, 1 << 62, n + 100, dtype=np.uint64)
        x, y = both[:n], np.concatenate([both[: n * 8 // 10], both[n : n + n // 5]])
        a, b = (order_minhash.sketches([order_minhash.sketch(v)]) for v in (x, y))
        passed += order_minhash.likely(a, b, np.array([n]), np.array([n]))[0]
    assert passed == 300


@pytest.mark.parametrize("n", [5, 10, 20, 26, 60])
def test_texts_at_the_bound_share_a_signature(n):
    missed, rng = 0, random.Random(n)
    for _ in range(3000):
        # 0.8 of the shingles in common, in one stretch: five-word shingles lose n / 5 at the end of each.
        base = [b"%d" % rng.randrange(1 << 40) for _ in range(n + 4 + n // 5)]
        a, b = base[: n + 4], base[n // 5 :]
        assert order_minhash.same(order_minhash.labelled_shingles(a), order_minhash.labelled_shingles(b))
        missed += not any(x == y for x, y in zip(order_minhash.signatures(a), order_minhash.signatures(b), strict=False))
    assert missed <= 1


def near_rows():
    rng, rows = random.Random(4), []
    common = words(60, 77)
    for g in range(25):
        base = words(120, 1000 + g, 5000)
        rows.append((10 * g, " ".join(base), "s"))
        for c in range(1, 5):
            copy = list(base)
            for _ in range(c - 1):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((10 * g + c, " ".join(copy).upper() if c == 2 else "\n".join(copy), "s"))
        rows.append((10 * g + 5, " ".join(common + words(90, 2000 + g, 5000)), "s"))  # shares a passage only
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows() + ODD
    got = order_minhash.near_duplicates(docs_df(spark, rows)).collect()
    texts = [order_minhash.labelled_shingles(order_minhash.text_words(t)).tolist() for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(texts):
        for j in range(i):
            need = 0.8 * max(len(a), len(texts[j]))
            if len(set(a) & set(texts[j])) >= need and plain_matches(a, texts[j]) >= need:
                root[find(i)] = find(j)
    want = {}
    for i, (d, t, _) in enumerate(rows):
        want.setdefault(find(i), []).append((d, hashlib.md5((t or "").encode()).hexdigest()))
    have = {}
    for r in got:
        have.setdefault((r["class_id"], r["class_fp"]), []).append((r["doc_id"], r["fp"]))
    key = lambda c: sorted(c, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    assert sorted(map(key, have.values()), key=str) == sorted(map(key, want.values()), key=str)
    kept = order_minhash.deduplicate(docs_df(spark, rows))
    assert kept.columns == docs_df(spark, ODD).columns and kept.count() == len(want)
    assert order_minhash.near_duplicates(docs_df(spark, ODD).limit(0)).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = [r for r in near_rows() if r[0] is not None] + [(800 + i, " ".join(["idiot", *words(30, i)]), "t") for i in range(60)]
    bench = [(1, " ".join(rows[5][1].split()[60:]))]  # not the passage that many share
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i >= 800)) for i, _, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in got}
    # Toxic ones, copies (4 of 5) and the leaked document are gone; what is left is one source, taken once.
    assert ids == {r[0] for r in rows if r[0] < 800 and r[0] % 10 in (0, 5)} - {5}
    assert sorted(r["start"] for r in got)[0] == 0 and len(got) == len(ids)
