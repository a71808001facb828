"""Training-data operators against brute force, round trips and held-out accuracy on small tables."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from oracle_compare import compare, duck
from textloom.llm import (
    best_fit_packing,
    compression_toxicity,
    decontaminate,
    jump_shards,
    repetition,
    simhash_pigeonring,
    suffix_family,
    text_density,
    token_store,
    warc_store,
)
from textloom.llm.components import components
from textloom.llm.word_ids import encoder
from textloom.session import fresh_path, ship_package

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, Doc_Id_ string, row string, _score string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def docs(spark, texts, ids=None):
    """A documents table with extra columns whose names come close to the operators' own."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOCS)


ODD_TEXTS = [None, "", " \n\t ", "a", "ä ö 日本 <|endoftext|> x\x1cy", "word " * 3000, "same text twice over", "same text twice over", "x" * 5000]
ODD_IDS = [5, None, 7, 8, 9, 10, 11, 11, 12]


# ---- toxicity


def test_toxicity_held_out_accuracy(spark):
    random.seed(3)
    plain = [f"w{random.randint(0, 400)}" for _ in range(5000)]
    bad = ["horrible", "despicable", "vileness", "wretched"]
    rows = []
    for i in range(600):
        words = random.choices(plain, k=random.randint(20, 120))
        toxic = i % 4 == 0
        for _ in range(max(3, len(words) // 15) if toxic else 0):
            words[random.randrange(len(words))] = random.choice(bad)
        rows.append((i, " ".join(words), int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = compression_toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic", F.lit(1).alias("quality")))
    got = {r["doc_id"]: r for r in compression_toxicity.score_documents(table, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"]} == {r[0] for r in held}
    assert np.mean([got[i]["predicted"] == y for i, _, y in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_toxicity_prior_of_all_labels(spark):
    random.seed(4)
    plain = [f"w{random.randint(0, 400)}" for _ in range(5000)]
    rows = []
    for i in range(900):
        words = random.choices(plain, k=60)
        for _ in range(random.randint(0, 3) if i % 9 == 0 else i % 40 == 1):
            words[random.randrange(len(words))] = random.choice(["horrible", "despicable", "vileness", "wretched"])
        rows.append((i, " ".join(words), int(i % 9 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    usable = table.where(~compression_toxicity.held_out(F.col("doc_id")))
    n = {t: usable.where(F.col("toxic") == t).count() for t in (0, 1)}
    fit = lambda most: compression_toxicity.fit(table, table, max_toxic=n[1], max_ordinary=most)
    whole, capped = fit(n[0]), fit(n[1])
    texts = {t: [r[1].encode() for r in rows if r[2] == t] for t in (0, 1)}
    assert np.mean([whole.score(t) for t in texts[0] + texts[1]]) == pytest.approx(1 / 9, abs=0.03)
    assert np.mean([capped.score(t) for t in texts[0] + texts[1]]) == pytest.approx(1 / 9, abs=0.05)
    sampled = compression_toxicity.train(texts[1], texts[0][:100])
    shifted = compression_toxicity.train(texts[1], texts[0][:100], (100, 800))
    assert shifted.slope == sampled.slope and shifted.bias - sampled.bias == pytest.approx(np.log(100 / 800))


def test_toxicity_odd_rows(spark):
    model = compression_toxicity.train([b"vile words here " * 4] * 40, [b"plain words there " * 4] * 40)
    got = compression_toxicity.score_documents(docs(spark, ODD_TEXTS, ODD_IDS), model).collect()
    assert len(got) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    assert compression_toxicity.train([], [b"a"]).score(b"x") == 0.0
    assert compression_toxicity.train([b"a"], []).score(b"x") == 1.0
    empty = docs(spark, [])
    fitted = compression_toxicity.fit(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert compression_toxicity.score_documents(empty, fitted).count() == 0


def test_windows_cover_the_text():
    for text in (b"", b"a", b"a b " * 100, b"x" * 1000, b" " * 300, "ä ö\n".encode() * 90):
        assert b"".join(compression_toxicity.windows(text)) == text


# ---- token ids, store and packing


def ids_of(text):
    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library():
    texts = ["İstanbul ẞ ΑΣ don't DON'T #1 ## <|endoftext|>foo <|ENDOFTEXT|> \xa0x ½ é́ 한국어 ’s", "\x1c a\x85b", None, "", "  ", "a1b2 ''t K Å", "ŉ ǆ \x00\x7f"]
    ids, at = encoder(TOKENIZER).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [ids_of(t) for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("width", [2, 4])
def test_token_store_round_trip(spark, width):
    path = fresh_path(spark, "store")
    token_store.write_store(docs(spark, ODD_TEXTS, ODD_IDS), path, TOKENIZER, 2, width, per_shard=3)
    got = Counter(map(tuple, token_store.read_documents(token_store.stored_keys(spark, path), path, width).collect()))
    order = sorted(zip(ODD_IDS, ODD_TEXTS, strict=True), key=lambda r: (r[0] is not None, r[0] or 0))
    want, start = [], 0
    for i, t in order:
        ids = [*ids_of(t), 2]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == Counter(want)
    foreign = spark.createDataFrame([(999, 0), (5, 1)], "doc_id long, copy long")
    assert token_store.lookup(foreign, path).count() == 0


@pytest.mark.parametrize("block, most", [(token_store.BLOCK_IDS, token_store.READ_IDS), (16, 64)])
def test_token_store_reads_the_keys_asked(spark, monkeypatch, block, most):
    monkeypatch.setattr(token_store, "BLOCK_IDS", block)
    monkeypatch.setattr(token_store, "READ_IDS", most)
    path = fresh_path(spark, "store")
    texts, ids = [*ODD_TEXTS, *["frequent key"] * 40], [*ODD_IDS, *[11] * 40]
    token_store.write_store(docs(spark, texts, ids), path, TOKENIZER, 2, 2, per_shard=3)
    asked = [(None, 0), (9, 0), (9, 0), (10, 0), (11, 41), (11, 42), (12, 0), (12, 1), (999, 0)]
    got = token_store.read(spark.createDataFrame(asked, "doc_id long, copy long"), path)
    assert got.columns == ["doc_id", "copy", "start", "ids"]
    text = dict(zip(ids, texts, strict=True))
    want = Counter((i, tuple([*ids_of(text[i]), 2])) for i, c in asked if i in (None, 9, 10) or (i, c) == (12, 0))
    rows = got.collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows if r.doc_id != 11) == want
    assert [r.copy for r in rows if r.doc_id == 11] == [41]
    copies = spark.createDataFrame([(11, c) for c in range(42)], "doc_id long, copy long")
    whole = {tuple([*ids_of(t), 2]) for t, i in zip(texts, ids, strict=True) if i == 11}
    assert {tuple(r.ids) for r in token_store.read(copies, path).collect()} == whole


def test_token_store_splits_a_hot_key(spark):
    ids = [7] * 300 + [None] * 150 + list(range(300))
    texts = [f"hot {i % 100}" for i in range(300)] + ["the same"] * 150 + [f"text {i}" for i in range(300)]
    path = fresh_path(spark, "tokens")
    token_store.write_store(docs(spark, texts, ids).repartition(5), path, TOKENIZER, per_shard=50)
    keys = token_store.stored_keys(spark, path)
    assert spark.read.parquet(f"{path}/keys").groupBy("shard").count().agg(F.max("count")).first()[0] <= 150
    assert spark.read.parquet(f"{path}/keys").where("doc_id = 7").select("shard").distinct().count() >= 4
    copies = Counter(map(tuple, keys.collect()))
    assert set(copies.values()) == {1}
    assert {c for k, c in copies if k == 7} == set(range(301)) and {c for k, c in copies if k is None} == set(range(150))
    got = token_store.read(keys, path).orderBy("start").collect()
    want = Counter((i, tuple([*ids_of(t), 2])) for i, t in zip(ids, texts))
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    assert [r.start for r in got] == [sum(len(x.ids) for x in got[:k]) for k in range(len(got))]


def test_token_store_reads_only_those_files(spark):
    path = fresh_path(spark, "store")
    token_store.write_store(docs(spark, [f"text {i}" for i in range(40)]), path, TOKENIZER, per_shard=4)
    at = {r.file: r.shard for r in spark.read.parquet(f"{path}/shards").collect()}
    assert len(at) > 4
    asked = spark.createDataFrame([(39, 0)], "doc_id long, copy long")
    holds = token_store.lookup(asked, path).first().shard
    folder = path.removeprefix("file://").removeprefix("file:")
    for file, shard in at.items():
        if shard != holds:  # files of other shards may be damaged: nothing reads them
            open(f"{folder}/ids/{file}", "wb").close()
    assert token_store.read(asked, path).first().ids == [*ids_of("text 39"), 2]
    with pytest.raises(Exception, match="damaged shard file"):
        token_store.read(spark.createDataFrame([(0, 0)], "doc_id long, copy long"), path).collect()


def test_perfect_hash_is_minimal():
    for n in (1, 2, 3, 1000, 20_000):
        keys = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
        assert sorted(token_store.mph_slots(keys, token_store.build_mph(keys), n)) == list(range(n))


def test_empty_store(spark):
    assert token_store.store_documents(docs(spark, []), TOKENIZER).count() == 0


def test_packing(spark):
    random.seed(1)
    texts = ODD_TEXTS + ["tok " * random.randint(1, 60) for _ in range(300)]
    ids = ODD_IDS + list(range(100, 400))
    got = best_fit_packing.pack_documents(docs(spark, texts, ids), TOKENIZER, capacity=50, end_id=0).collect()
    want = Counter()
    for i, t in zip(ids, texts, strict=True):
        tokens = [*ids_of(t), 0]
        for piece, at in enumerate(range(0, len(tokens), 50)):
            part = tokens[at:at + 50]
            want[(i, piece, at, len(part), crc(part))] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= 50
    assert len(bins) <= 1.02 * sum(r["length"] for r in got) / 50 + 2
    assert best_fit_packing.pack_documents(docs(spark, []), TOKENIZER).count() == 0


def test_packed_sequences_hold_the_ids(spark):
    random.seed(2)
    texts = ODD_TEXTS + ["tok " * random.randint(1, 60) for _ in range(300)]
    table, path = docs(spark, texts).repartition(3), fresh_path(spark, "packed")
    best_fit_packing.write_sequences(table, TOKENIZER, capacity=50, end_id=0, path=path)
    parts = {}
    for r in spark.read.parquet(path).collect():
        ids = np.frombuffer(r["ids"], best_fit_packing.id_kind(TOKENIZER, 0)).tolist()
        assert len(ids) == sum(p["length"] for p in r["pieces"]) <= 50
        for p in r["pieces"]:
            parts[p["doc_id"], p["start"]] = ids[p["offset"]:p["offset"] + p["length"]]
    whole = {}
    for (i, _), ids in sorted(parts.items()):
        whole.setdefault(i, []).extend(ids)
    assert whole == {i: [*ids_of(t), 0] for i, t in enumerate(texts)}


def test_bin_plans_hold_every_piece():
    for seed in range(200):
        random.seed(seed)
        capacity = random.choice([3, 10, 30, 2048])
        lengths = {random.randint(1, capacity): random.randint(1, 40) for _ in range(random.randint(0, 50))}
        used = Counter()
        for count, items in best_fit_packing.plan_bins(lengths, capacity):
            assert sum(n * each for n, each in items) <= capacity
            assert sum(each for n, each in items if 3 * n > capacity) <= 2
            for n, each in items:
                used[n] += count * each
        assert used == Counter(lengths)


# ---- repetition


def repeats_brute(text, least):
    words = (text or "").encode().split()
    longest = [max((next(k for k in range(len(words) + 1) if i + k >= len(words) or j + k >= len(words) or words[i + k] != words[j + k])
                    for j in range(len(words)) if j != i), default=0) for i in range(len(words))]
    covered = {p for i, n in enumerate(longest) if n >= least for p in range(i, i + n)}
    three = {p for i, n in enumerate(longest) if n >= 3 for p in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(three), len(covered),
            max(longest, default=0))


def test_repetition_brute_force():
    random.seed(2)
    texts = [None, "", " ", "a", "é é\né é"] + ["".join(random.choice(["a ", "b ", "c\n", "ab ", "#é\t"]) for _ in range(random.randint(0, 60))) for _ in range(150)]
    m = repetition.measure(pa.array(texts), 4)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
    assert [tuple(int(m[c][i]) for c in names) for i in range(len(texts))] == [repeats_brute(t, 4) for t in texts]


def test_repetition_verdicts(spark):
    random.seed(21)
    w = lambda n: " ".join(f"w{random.randrange(10 ** 6)}" for _ in range(n))
    clean, passage, few = w(200), w(60), w(15)
    texts = [clean, "a b c " * 100, passage + " x " + w(900) + " " + passage, None, "short", clean + " " + few + " y " + few, few + " z " + w(300) + " " + few,
             w(30_000), passage + " " + w(30_000) + " " + passage, "", w(49), w(50), clean, clean]
    for _ in range(60):  # texts about the limits: some passages twice, of several lengths
        parts = [w(random.choice([6, 8, 12, 30, 51])) for _ in range(4)]
        texts.append(" ".join(random.choices(parts, k=random.randint(0, 5)) + [w(random.randint(30, 400))]))
    rows = {r["doc_id"]: r for r in repetition.judge_documents(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        if i in (7, 8):
            continue  # too long for the brute force
        n, _, _, _, three, covered, longest = repeats_brute(t, 8)
        failed = n < 50 or 100 * three > 50 * n
        assert (rows[i]["base_failed"], rows[i]["kept"]) == (failed, not failed and covered <= 0.12 * n and longest <= 50), i
    assert [rows[i]["kept"] for i in range(14)] == [True, False, False, False, False, False, True, True, False, False, False, True, True, True]
    assert not any(rows[i]["base_failed"] for i in (2, 5, 8)) and sum(not r["kept"] and not r["base_failed"] for r in rows.values()) > 10
    assert repetition.judge_documents(docs(spark, [])).count() == 0


# ---- archive


def test_archive_round_trip(spark):
    rows = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "http://a/\n4", ""), (None, "http://n", "<p>x</p>"),
            (5, "http://same", "twice"), (5, "http://same", "twice"), (6, "u", "é" * 4000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, Payload string")
    got = Counter(map(tuple, warc_store.page_records(pages).collect()))
    want = Counter()
    seen = set()
    for i, u, h in rows:
        data = (h or "").encode()
        top = max((x or -1) for x, _, y in rows if (y or "") == (h or ""))
        first = i == top and (i, u) not in seen
        seen.add((i, u))
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", None if first else top)] += 1
    assert got == want
    assert warc_store.page_records(pages.limit(0)).count() == 0


def test_archive_keeps_payloads_once_and_exports(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "same" if i < 5 else f"p{i}") for i in range(8)], "page_id long, url string, html string")
    path = fresh_path(spark, "warc")
    warc_store.write_archive(pages, path)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    warc_store.write_warc_files(spark, path, f"{path}/export", 1)
    data = b"".join(r["content"] for r in spark.read.format("binaryFile").load(f"{path}/export").collect())
    records = data.split(b"WARC/1.1\r\n")[1:]
    assert len(records) == 8 and all(r.endswith(b"\r\n\r\n") for r in records)
    b32 = lambda b: b"sha1:" + base64.b32encode(hashlib.sha1(b).digest())
    ids, refers = {}, set()
    for r in records:
        head, _, block = r[:-4].partition(b"\r\n\r\n")
        lines = dict(x.split(b": ", 1) for x in head.split(b"\r\n"))
        assert int(lines[b"Content-Length"]) == len(block) and lines[b"WARC-Block-Digest"] == b32(block)
        if lines[b"WARC-Type"] == b"response":
            http, _, payload = block.partition(b"\r\n\r\n")
            assert http.startswith(b"HTTP/1.1 200 OK\r\n") and lines[b"WARC-Payload-Digest"] == b32(payload)
            ids[lines[b"X-Page-Id"]] = lines[b"WARC-Record-ID"]
        else:
            refers.add((lines[b"X-Refers-To-Page-Id"], lines[b"WARC-Refers-To"]))
            assert block == b"" and lines[b"WARC-Payload-Digest"] == b32(b"same")
    assert len(ids) == 4 and refers == {(b"4", ids[b"4"])}


def test_damaged_archives_raise(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i}") for i in range(3)], "page_id long, url string, html string")
    path, part = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    warc_store.write_archive(pages, path)
    payloads = spark.read.parquet(f"{path}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{part}/records")
    payloads.limit(2).write.parquet(f"{part}/payloads")
    with pytest.raises(Exception, match="no payload at"):
        warc_store.read_records(spark, part).collect()
    other = fresh_path(spark, "warc")
    spark.read.parquet(f"{path}/records").write.parquet(f"{other}/records")
    payloads.withColumn("payload", F.lit(b"x")).write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="damaged payload at"):
        warc_store.read_records(spark, other).collect()
    cut = warc_store.read_records(spark, path).withColumn("record", F.expr("substring(record, 1, octet_length(record) - 1)"))
    with pytest.raises(Exception, match="broken record"):
        warc_store.parse_records(cut).select("body").collect()


def test_short_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy")], "page_id long, url string, html string")
    assert {r["record_type"] for r in warc_store.page_records(pages, min_bytes=3).collect()} == {"response"}


# ---- extraction

PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Menu</a></li></ul></nav>'
        '<div class="cookie-notice">We use cookies on this site, please accept them all.</div><div class="ad">Buy now</div>%s<aside>Side</aside>'
        '<div id="comments"><p>First! What a long comment this is, longer than any paragraph of the article itself, by far and away.</p></div>'
        '<footer>&copy; x</footer></body></html>')


def test_extraction():
    body = "<article><h1>Head &amp; line</h1><p><b>One  two<br>three<p>Four &eacute;<i>f</i></p><form>Name <input></form><p>Five.</p></article>"
    want = "Head & line One two three Four éf Five."
    assert text_density.extract(PAGE % body) == want
    assert text_density.extract(PAGE % body.replace("article", "section")) == want
    assert text_density.extract((PAGE % body)[:-40]) == want
    assert [text_density.extract(x) for x in (None, "", "<p>", "plain text", "<div>a<div>b" * 3)] == ["", "", "", "plain text", "a b a b a b"]
    assert text_density.extract("<div>" * 20_000 + "deep") == "deep"


def prose(word, n, paragraphs=3):
    """Paragraphs of n words each, and the text they are."""
    texts = [" ".join(f"{word}{k}x{i}" for i in range(n)) for k in range(paragraphs)]
    return "".join(f"<p>{t}</p>" for t in texts), " ".join(texts)


def test_extraction_directly_under_body():
    assert text_density.extract("<body><p>Alpha one</p><p>Beta two</p><p>Gamma three</p></body>") == "Alpha one Beta two Gamma three"
    (a, a_text), (b, b_text), (c, c_text) = prose("a", 40), prose("b", 20), prose("c", 3, 1)
    sections = "".join(f"<section><h2>Part</h2>{x}</section>" for x in (a, b, c))
    want = f"Part {a_text} Part {b_text} Part {c_text}"
    assert text_density.extract(f"<body>{sections}</body>") == want
    assert text_density.extract(PAGE % sections) == want
    assert text_density.extract(f"<body><div>{b}</div><div>{a}</div></body>") == f"{b_text} {a_text}"
    links = "<div><ul>" + "<li><a href='/'>Another page</a></li>" * 12 + "</ul></div>"
    assert text_density.extract(f"<body>{links}<div>{a}</div>{links}</body>") == a_text


def test_extraction_article_cards():
    story, text = prose("s", 60, 5)
    cards = "".join(f"<article><h3>Card {i}</h3><p>Teaser of {i}.</p></article>" for i in range(3))
    for page in (f"<body>{cards}<div>{story}</div></body>", f"<body><main>{cards}</main><div><div>{story}</div></div></body>"):
        assert text_density.extract(page) == text


def test_extraction_wrapper_classes():
    story, text = prose("s", 40)
    for names in ("layout with-sidebar", "no-sidebar", "has-header", "page site-footer-fixed", "sidebar", "header menu", "cookie-notice"):
        page = f'<body><div class="{names}"><article>{story}</article><div class="sidebar"><p>Side text</p></div></div><footer>Foot</footer></body>'
        assert text_density.extract(page) == text, names
    assert text_density.extract(f"<body><form><nav>Menu</nav><div id='comments'>{story}</div></form><p>x</p></body>") == text
    assert text_density.extract(f"<body><article>{story}<div class='legal-history'><p>Of law</p></div><div class='share'>Share it</div></article></body>") == text + " Of law"
    comments = "<div id='comments'>" + "<div><span>Name</span> <b>at</b> <p>A remark of a few words</p></div>" * 30 + "</div>"
    assert text_density.extract(f"<body><article>{story}</article>{comments}</body>") == text
    assert text_density.extract(f"<body><article><p>Short</p></article><footer>{story}</footer></body>") == "Short"
    assert text_density.extract(f"<body><div hidden>{story}</div><p>x</p></body>") == "x"


def test_extraction_junk_inside_the_wrapper():
    story, text = prose("s", 40)
    remark = "<div class='c'><span>Name {}</span><p>I read this with some interest and don't agree.</p></div>"
    remarks = "".join(map(remark.format, range(6)))
    items = "".join(f"<li>By me: <a href='/{i}'>Another page to read {i}</a></li>" for i in range(6))
    junk = (f"<div class='comment-list'>{remarks}</div>", f"<section id='user-comments'><h3>What readers say</h3><ul>{remarks.replace('div', 'li')}</ul></section>",
            f"<div class='related-posts'><h4>More</h4><ul>{items}</ul></div>", f"<div class='more-of-this'><ul>{items.replace('By me: ', '')}</ul></div>",
            "<div class='cookie-bar'>This site stores small files. <button>Fine</button></div>", "<div class='newsletter-box'><h4>Our letter</h4><p>Every week in your mail.</p></div>",
            "<div class='ad-slot'>Buy now</div>", "<div class='site-footer'><p>Made by us</p></div>")
    for block in junk:
        for page in (f"<body><div class='wrap'>{story}{block}</div></body>", f"<body><div class='wrap'>{block}{story}</div></body>",
                     f"<body><div class='wrap'><div>{story}</div>{block}</div><footer>Foot</footer></body>", f"<body><div class='wrap'>{story}</div>{block}</body>"):
            assert text_density.extract(page) == text, page[-400:]
    assert text_density.extract(f"<body><div class='wrap'>{story}{''.join(junk)}</div></body>") == text


def test_extraction_names_that_only_contain_a_word():
    (a, a_text), (b, b_text) = prose("a", 40), prose("b", 30)
    assert text_density.extract(f"<body><div class='part with-ads'>{a}</div><div class='part with-ads'>{b}</div></body>") == f"{a_text} {b_text}"
    sections = "".join(f"<div><h2>Part</h2>{x}</div>" for x in (a, b, a))
    assert text_density.extract(f"<body><div class='no-comments'>{sections}</div></body>") == f"Part {a_text} Part {b_text} Part {a_text}"
    steps = "<ul><li><b>One</b> <p>Turn it on.</p></li><li><b>Two</b> <p>Wait a bit.</p></li><li><b>Three</b> <p>Turn it off.</p></li></ul>"
    assert text_density.extract(f"<body><article class='page'>{a}{steps}</article></body>") == a_text + " One Turn it on. Two Wait a bit. Three Turn it off."
    index = "".join(f"<li><a href='/{i}'>Page {i}</a></li>" for i in range(4))
    assert text_density.extract(f"<body><ul>{index}</ul></body>") == "Page 0 Page 1 Page 2 Page 3"


def test_extraction_frame(spark):
    pages = spark.createDataFrame([(1, "u", PAGE % "<article><p>Text</p></article>", "x"), (None, None, None, "x"), (1, "u", "", "x")], "page_id long, url string, html string, Text string")
    assert sorted(map(str, text_density.extract_pages(pages).collect())) == sorted(
        map(str, [("Row(page_id=1, url='u', text='Text', n_chars=4)"), ("Row(page_id=None, url=None, text='', n_chars=0)"), ("Row(page_id=1, url='u', text='', n_chars=0)")]))
    assert text_density.extract_pages(pages.limit(0)).count() == 0


# ---- suffix arrays


def removed_brute(texts):
    found = Counter(b[p:p + 200] for b in texts for p in range(len(b) - 199))
    out = []
    for b in texts:
        hit = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 199):
            if found[b[p:p + 200]] > 1:
                hit[p] += 1
                hit[p + 200] -= 1
        gone = np.cumsum(hit)[:-1] > 0
        starts = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]]))) if len(b) else 0
        out.append((len(b), int(gone.sum()), starts, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def repeat_texts():
    random.seed(5)
    words = ["the", "of", "ä", "and", "rend", "threlyes", "wh", "über"]
    run = lambda n: " ".join(random.choice(words) + random.choice(["", "a", ".", "é"]) + str(random.randint(0, 99)) for _ in range(n))
    passages = [run(random.randint(20, 90)) for _ in range(8)]
    texts = [None, "", "x" * 199, "x" * 200, "x" * 500, "ab" * 150]
    for _ in range(90):
        t = run(random.randint(0, 60))
        for _ in range(random.randint(0, 3)):
            q = random.choice(passages)
            t += " " + (q if random.random() < 0.5 else q[random.randint(0, len(q) // 2):random.randint(len(q) // 2, len(q))]) + " " + run(random.randint(0, 10))
        texts.append(t)
    near = [t[:i] + "Q" + t[i + 1:] for t in [texts[40] + texts[41] + texts[42]] for i in range(0, 300, 37)]
    return texts + texts[20:30] + near


@pytest.mark.parametrize("batches", [1, 5])
def test_suffix_family_brute_force(spark, batches):
    texts = repeat_texts()
    got = {r[0]: tuple(r)[1:] for r in suffix_family.removal_report(docs(spark, texts), batches).collect()}
    assert [got[i] for i in range(len(texts))] == removed_brute([(t or "").encode() for t in texts])


def test_suffix_family_long_text_in_parts():
    data = bytes(random.Random(1).choices(range(97, 103), k=3 * suffix_family.CHUNK // 2)) if suffix_family.CHUNK <= 1 << 20 else b""
    parts = list(suffix_family._chunks(iter([(1, memoryview(data))])))
    covered = sorted(p for d, _, begins, ends in parts for a, z, s in zip([0, *ends[:-1]], ends, begins, strict=True) for p in (s, s + (z - a) - 200))
    assert covered[0] == 0 and covered[-1] == len(data) - 200


def test_remove_repeats_keeps_rows(spark):
    rows = spark.createDataFrame([(1, "é" * 150, "s", 150), (2, "a" + "é" * 150, "s", 151), (3, None, "s", None), (3, "short", "s", 5)], "doc_id long, text string, row string, n_chars long")
    out = {(r["doc_id"], r["text"]): r for r in suffix_family.remove_repeats(rows).collect()}
    assert set(out) == {(1, ""), (2, "a"), (3, None), (3, "short")} and out[(2, "a")]["n_chars"] == 1
    assert suffix_family.remove_repeats(rows.limit(0)).count() == 0


# ---- decontamination


def test_decontamination(spark):
    item = " ".join(f"q{i}" for i in range(30))
    other = " ".join(f"z{i}" for i in range(12))
    near = item.replace("q15", "changed")
    texts = ["Intro words. " + item.upper() + " tail", near, item[: len(item) // 2] + " " + " ".join(f"y{i}" for i in range(30)), None, "", other, "few words", "few words", "clean text " * 30]
    bench = spark.createDataFrame([(1, item, "x"), (2, other, "x"), (3, None, "x"), (4, "few words", "x"), (5, "", "x")], "item_id long, text string, Item string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(docs(spark, texts), bench).collect()}
    assert set(got) == {(0, 1), (5, 2), (6, 4), (7, 4)} and set(got.values()) == {1.0}  # one word changed costs 5 of 26 shingles: 21 / 31
    kept = decontaminate.remove_contaminated(docs(spark, texts), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 8] and kept.columns == docs(spark, []).columns
    assert decontaminate.contaminated(docs(spark, []), bench).count() == 0
    assert decontaminate.contaminated(docs(spark, texts), bench.limit(0)).count() == 0


def contaminated_brute(texts, items):
    """(doc, item) -> (similarity, first shingle) by the counts of every window."""
    def cut(text):
        words = (text or "").lower().split()
        return [tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))] if words else []

    out = {}
    for (i, text), (j, item) in [(d, b) for d in enumerate(texts) for b in items]:
        have, want = cut(text), cut(item)
        best = (0.0, 0)
        for at in range(max(len(have) - len(want), 0) + 1):
            a, b = Counter(have[at:at + len(want)]), Counter(want)
            best = max(best, (sum((a & b).values()) / max(sum((a | b).values()), 1), -at))
        if best[0] >= 0.8:
            out[i, j] = (round(best[0], 6), -best[1])
    return out


def test_decontamination_of_repeated_and_templated_items(spark):
    run = lambda w, n: " ".join(f"{w}{i}" for i in range(n))
    twice, often, lead = run("q", 59), run("z", 59), run("lead", 40)
    items = [(i, twice) for i in range(2)] + [(i, often) for i in range(10, 20)] + [(i, f"{lead} {run(f'n{i}x', 19)}") for i in range(30, 36)]
    changed = lambda text, word: f"before it {text.replace(f' {word} ', ' changed ')} and after"
    texts = [changed(twice, "q30"), changed(often, "z30"), changed(items[-1][1], "lead20"), twice, lead, "clean text " * 30]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_shingle"]) for r in decontaminate.contaminated(docs(spark, texts), bench).collect()}
    want = contaminated_brute(texts, items)
    assert got == want and {(0, 0), (0, 1), (2, 35)} | {(1, i) for i in range(10, 20)} < set(want) and want[0, 0][0] == 0.833333
    assert sorted(r["doc_id"] for r in decontaminate.remove_contaminated(docs(spark, texts), bench).collect()) == [4, 5]


def test_simhash_columns(spark):
    hashes = [random.Random(i).getrandbits(63) - (1 << 62) for i in range(9)]
    got = spark.createDataFrame([(hashes,)], "h array<bigint>").select(decontaminate.simhash(F.col("h"))).first()[0]
    want = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > 9)
    assert got % (1 << 64) == want


# ---- sharding


def jump_one(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * jump_shards.JUMP_MULTIPLIER + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    for n in (1, 2, 40, 41):
        assert jump_shards.jump_hash(keys, n).tolist() == [jump_one(int(k), n) for k in keys]


def test_shards(spark):
    ids = ODD_IDS + list(range(1000, 1400))
    texts = ODD_TEXTS + ["t"] * 400
    got = jump_shards.document_shards(docs(spark, texts, ids), 7).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True))
    for s in range(7):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 7) for r in got)
    assert all(len({r["shard"] for r in got if r["doc_id"] == i}) == 1 for i in (11, None))
    key = int(hashlib.md5(b"1000").hexdigest()[:16], 16)
    assert next(r["shard"] for r in got if r["doc_id"] == 1000) == jump_one(key, 7)
    assert jump_shards.document_shards(docs(spark, [])).count() == 0


# ---- near duplicates


def print_brute(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(prints, ids, distance):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(prints))]


def test_near_duplicates_brute_force(spark):
    random.seed(9)
    base = [" ".join(random.choices([f"w{i}" for i in range(300)], k=random.randint(60, 200))) for _ in range(25)]
    texts, ids = list(ODD_TEXTS), list(ODD_IDS)
    for k, b in enumerate(base):
        words = b.split()
        for c in range(6):
            edited = list(words)
            if c:
                edited[random.randrange(len(words))] = "EDIT"
            texts.append(" ".join(edited))
            ids.append(1000 + 10 * k + c)
    prints = [print_brute(t) for t in texts]
    got = Counter(map(tuple, simhash_pigeonring.near_duplicates(docs(spark, texts, ids)).collect()))
    assert got == Counter(zip(ids, [f"{p:016x}" for p in prints], components_brute(prints, ids, 4), strict=True))
    kept = simhash_pigeonring.deduplicate(docs(spark, texts, ids))
    want = {c for c in components_brute(prints, ids, 4) if c is not None}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(want)
    assert kept.columns == docs(spark, []).columns
    assert simhash_pigeonring.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [100_000, 20])
def test_links_of_dense_buckets(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash_pigeonring, "HOT", hot)
    random.seed(hot)
    prints = {random.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        x = p
        for _ in range(12):
            for _ in range(random.randint(1, 4)):
                x ^= 1 << random.randrange(64)
            prints.add(x)
    hub = random.getrandbits(64)
    for _ in range(900):  # one dense group, above the size from which pivots are used
        x = hub
        for _ in range(random.randint(1, 3)):
            x ^= 1 << random.randrange(64)
        prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash_pigeonring.near_edges(spark.createDataFrame([(p,) for p in signed], "fp long"), 4)
    root = dict(map(tuple, components(edges).collect()))
    got = [root.get(p, p) for p in signed]
    want = components_brute(prints, list(range(len(prints))), 4)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}
    assert components(edges.limit(0)).count() == 0


# ---- queries and pipeline


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.startswith("op")))
def test_oracles(spark, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF, duck(SF))
    assert r["schema_match"] and r["value_match"], r


def test_pipeline_is_its_stages_by_brute_force(spark):
    import corpus_pipeline

    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    model = compression_toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    left = [(r["doc_id"], r["text"]) for r in rows if model.score((r["text"] or "").encode()) < 0.5]
    group = components_brute([print_brute(t) for _, t in left], [i for i, _ in left], 4)
    left = [r for r, g in zip(left, group, strict=True) if r[0] == g]
    texts = [(t or "").encode() for _, t in left]
    found = Counter(b[p:p + 200] for b in texts for p in range(len(b) - 199))
    cut = []
    for (i, _), b in zip(left, texts, strict=True):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 199):
            if found[b[p:p + 200]] > 1:
                gone[p:p + 200] = True
        cut.append((i, bytes(np.frombuffer(b, np.uint8)[~gone]).decode("utf-8", "ignore")))
    table = spark.createDataFrame(cut, "doc_id long, text string")
    con = duck(SF)
    con.execute("DROP VIEW documents")
    con.register("cut", table.toPandas())
    con.execute("CREATE VIEW documents AS SELECT * FROM cut")
    bad = {r[0] for r in con.execute(decontaminate.ORACLE_SQL).fetchall()}
    want = Counter()
    for i, t in cut:
        if i not in bad:
            ids = [*ids_of(t), 0]
            for at in range(0, len(ids), 2048):
                want[(i, at // 2048, at, len(ids[at:at + 2048]), crc(ids[at:at + 2048]))] += 1
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
