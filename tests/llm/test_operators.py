"""Edge cases, brute-force versions and round trips of the corpus operators."""

import hashlib
import itertools
import math
import re
import time
import tracemalloc
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulselake.llm import exact_dedup, html_text, language, line_dedup, maxscore, mixing, pieces, queries, sharding, simhash, toxicity
from tests.conftest import SF

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, "The cat sat on the mat today", "en", "a", 1),
    (2, "The  cat sat on\tthe mat today", "en", "a", 1),
    (2, "The  cat sat on\tthe mat today", "en", "a", 1),
    (3, None, None, "b", None),
    (4, "", "en", None, 0),
    (5, " \n\t ", "de", None, 3),
    (None, "der Hund und die Katze", "de", "b", 1),
    (6, LONG, "en", "c", 9),
    (7, LONG + " x", "en", "c", 9),
    (8, "123 !!!", "fr", "c", 7),
    (9, "▁ space  sign ▁▁ é\U0001f600\x00 ", "fr", "a", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
DOCUMENT_OPERATORS = {
    "shard": sharding.shard,
    "encode": pieces.encode_documents,
    "exact": exact_dedup.exact_dedup,
    "mix": mixing.mix,
    "lines": line_dedup.line_dedup,
    "language": language.identify,
    "simhash": simhash.near_duplicates,
}


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    # Extra columns with names the operators use themselves.
    for name in ("size", "shard", "kept", "sha", "fp", "line", "score", "in_id", "start", "h1"):
        frame = frame.withColumn(name, F.lit("extra"))
    return frame


@pytest.mark.parametrize("name", DOCUMENT_OPERATORS)
def test_every_row_has_a_result(docs, name):
    rows = DOCUMENT_OPERATORS[name](docs).collect()
    if name == "lines":
        assert len(rows) == sum(len(t.split("\n")) for _, t, *_ in ROWS if t is not None)
    else:
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", DOCUMENT_OPERATORS)
def test_empty_table(spark, name):
    assert DOCUMENT_OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


def test_shards_are_gapless_and_count_bytes(docs):
    rows = sharding.shard(docs, 4).collect()
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    texts = {i: t or "" for i, t, *_ in ROWS}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))


def test_shard_of_one_hot_text_is_cut(spark):
    frame = spark.createDataFrame([(i, "same" if i % 3 else f"own {i}") for i in range(3000)], "doc_id long, text string")
    sizes = [r["n"] for r in sharding.shard(frame).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.06 * min(sizes)


def test_exact_dedup_against_brute_force(docs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    rows = exact_dedup.exact_dedup(docs).collect()
    by_sha = {}
    for i, t, *_ in ROWS:
        by_sha.setdefault(hashlib.sha256(norm(t).encode()).hexdigest(), []).append(i)
    for r in rows:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == min((i for i in ids if i is not None), default=None)
    assert sum(r["kept"] for r in rows) == len(by_sha)


def test_fingerprints_compose_and_collisions_are_told_apart(spark, monkeypatch):
    whole = b"abc" * 50_000
    tables = [exact_dedup.powers(b, p, exact_dedup.CHUNK) for b, p in zip(exact_dedup.BASES, exact_dedup.PRIMES)]
    parts = [whole[i : i + exact_dedup.CHUNK] for i in range(0, len(whole), exact_dedup.CHUNK)]
    ends = np.cumsum([len(p) for p in parts])
    for k, (base, prime) in enumerate(zip(exact_dedup.BASES, exact_dedup.PRIMES)):
        direct = 0
        for byte in whole:
            direct = (direct * base + byte + 1) % prime
        combined = sum(exact_dedup.chunk_terms(p, len(whole) - int(e), tables)[k] for p, e in zip(parts, ends)) % prime
        assert combined == direct
    # All texts of one length share a fingerprint: the comparison alone must tell them apart.
    real = exact_dedup.fingerprints
    monkeypatch.setattr(
        exact_dedup, "fingerprints", lambda d: real(d).withColumn("f1", F.lit(0).cast("long")).withColumn("f2", F.lit(0).cast("long"))
    )
    frame = spark.createDataFrame([(i, f"text {i % 3}") for i in range(9)], "doc_id long, text string")
    assert {(r["doc_id"], r["keep_id"]) for r in exact_dedup.exact_dedup(frame).collect()} == {(i, i % 3) for i in range(9)}


def test_long_documents_are_hashed_in_parts(spark):
    frame = spark.createDataFrame([(1, LONG), (2, LONG), (3, "x")], "doc_id long, text string")
    spread = {r["doc_id"]: (r["f1"], r["f2"]) for r in exact_dedup.fingerprints(frame, spread=1000).collect()}
    assert spread == {r["doc_id"]: (r["f1"], r["f2"]) for r in exact_dedup.fingerprints(frame).collect()}


def test_mix_meets_targets(docs):
    rows = mixing.mix(docs, carry_source=True).collect()
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == math.floor(own[0]["target"])
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)
    again = mixing.mix(docs.repartition(5), carry_source=True).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_mix_shares_the_weight_of_sources_without_words(spark):
    for sizes, want in (
        ((100, 100, 0), (1000 / 7, 400 / 7, 0)),
        ((0, 0, 100), (0, 0, 100)),
        ((0, 0, 0), (0, 0, 0)),
        ((10, 100, 0), (30, 80, 0)),
    ):
        frame = spark.createDataFrame(list(zip("abc", sizes)), "source string, size long")
        got = [r["target"] for r in mixing.targets(frame).orderBy("source").collect()]
        assert got == pytest.approx(want)


def test_schedule_keeps_prefixes_near_the_targets(spark):
    sizes = spark.createDataFrame([(s, 100_000) for s in "abc"], "source string, size long")
    goals = mixing.targets(sizes)
    goals = spark.createDataFrame(goals.collect(), goals.schema)
    slots = sorted(mixing.schedule(goals, 100).collect())
    share = {r["source"]: r["words"] / 300_000 for r in goals.collect()}
    for upto in (100, 1000, 2500):
        for source, part in share.items():
            assert abs(sum(s[1] == source for s in slots[:upto]) - part * upto) < 12


def test_viterbi_against_all_segmentations():
    coder = pieces.Coder(pieces.load())
    vocabulary = coder.automaton.v
    score = {p: s for p, s, plain in zip(vocabulary.pieces, vocabulary.scores, vocabulary.plain) if plain}
    for word in ("▁the", "▁nation", "▁reading", "▁▁a", "▁zyx"):
        best = max(
            sum(score.get(p, -1e12) for p in parts)
            for cuts in range(len(word))
            for at in itertools.combinations(range(1, len(word)), cuts)
            for parts in [[word[a:b] for a, b in zip((0, *at), (*at, len(word)))]]
        )
        ids = coder.automaton.segment(word)
        assert sum(vocabulary.scores[i] for i in ids) == best
        assert "".join(vocabulary.pieces[i] for i in ids) == word


def test_long_words_and_texts_are_coded_like_short_ones(monkeypatch):
    coder = pieces.Coder(pieces.load())
    texts = ["thequickbrownfox" * 3, LONG[:5000], "▁é  x\U0001f600"]
    want = [coder.encode(t) for t in texts]
    monkeypatch.setattr(pieces, "MEMO_CHARS", 2)
    monkeypatch.setattr(pieces, "PIECE", 4)
    coder = pieces.Coder(coder.automaton.v)
    assert [coder.encode(t) for t in texts] == want


def test_decoding_gives_texts_back(spark, docs):
    coded = pieces.encode(docs.select("doc_id", "text"), ["doc_id", "text"])
    rows = coded.collect()
    assert all(r["round_trip"] is True for r in rows if r["text"] is not None)
    assert [r["ids"] for r in rows if not r["text"]] == [[], []]
    back = pieces.decode(coded.withColumnRenamed("text", "was"), ["was"]).filter("was is not null").collect()
    assert all(r["was"] == r["text"] for r in back)


def test_top_k_edges(spark):
    rows = [(0, [1.0, -2.0]), (100, [0.5]), (1, [2.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [2.0, 2.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (1, [2.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    found = [tuple(r) for r in maxscore.top_k(frame).orderBy("query_id", "rank").collect()]
    scale = 1024 * 1024
    assert found == [
        (0, 1, 100, scale // 2),
        (0, 2, 1, -2 * scale),
        (0, 3, 1, -2 * scale),
        (0, 4, 4, -2 * scale),
        (100, 1, 1, scale),
        (100, 2, 1, scale),
        (100, 3, 4, scale),
        (100, 4, 0, scale // 2),
    ]
    assert maxscore.top_k(frame.limit(0)).count() == 0


def test_top_k_takes_every_row_of_an_id(spark):
    rows = [(0, [1.0, 0.0]), (7, [0.1, 0.0]), (7, [5.0, 0.0]), (7, [5.0, 0.0]), (8, [1.0, 0.0]), (0, [9.0, 9.0])]
    rows += [(9, [2.0, 0.0])] * 40 + [(100, [0.0, 1.0]), (100, [0.0, -1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    scores = {}
    for q, one in ((i, v) for i, v in rows if i % 100 == 0):
        whole = [(-sum(int(1024 * a) * int(1024 * b) for a, b in zip(one, other)), i) for i, other in rows if i != q]
        scores[q] = scores.get(q, []) + whole
    want = [(q, r + 1, i, -s) for q, found in scores.items() for r, (s, i) in enumerate(sorted(found)[:10])]
    assert [tuple(r) for r in maxscore.top_k(frame).orderBy("query_id", "rank").collect()] == sorted(want)


def test_top_k_of_huge_components(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(r["vec_id"], r["score"]) for r in maxscore.top_k(frame).orderBy("rank").collect()]
    assert found == [(1, (1 << 63) - 1), (3, 2 * 1024 * 1024), (2, -(1 << 63))]


def test_top_k_against_brute_force(spark):
    draw = np.random.default_rng(5)
    for data in (draw.normal(size=(700, 12)), np.round(draw.normal(size=(300, 3)), 1), draw.normal(size=(60, 4)) * 1e9):
        frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
        whole = np.floor(1024 * data).astype(np.int64).astype(object)
        if abs(whole).max() > 1e10:
            whole, frame = np.floor(1024 * (data / 1e4)).astype(np.int64).astype(object), frame.withColumn("embedding", F.transform("embedding", lambda x: x / 1e4))
        for r_id in range(0, len(data), 100):
            scores = whole @ whole[r_id]
            want = sorted((-int(s), i) for i, s in enumerate(scores) if i != r_id)[:10]
            got = maxscore.top_k(frame).filter(F.col("query_id") == r_id).orderBy("rank").collect()
            assert [(-r["score"], r["vec_id"]) for r in got] == want


def test_simhash_components_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)  # so that subtrees are dealt into blocks
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = set(int(b) for b in base)
    for b in base[:6]:
        for _ in range(60):
            v = int(b)
            for bit in draw.choice(64, draw.integers(1, 7), replace=False):
                v ^= 1 << int(bit)
            values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame)).collect()}
    label = list(range(len(values)))
    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= 3 and label[i] != label[j]:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    for i, j in itertools.combinations(range(len(values)), 2):
        same = roots.get(signed[i], signed[i]) == roots.get(signed[j], signed[j])
        assert same == (label[i] == label[j])


def test_simhash_of_short_texts():
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \t") == 0
    assert simhash.fingerprint(b"One Two") == simhash.fingerprint(b"one\n two ")


def test_line_dedup_within_one_edit(spark):
    line = "the quick brown fox jumps over the dog"
    rows = [(1, f"{line}\n\nshort one"), (2, f"{line[:10]}X{line[11:]}\nshort ono"), (3, line[1:]), (4, line + "!"), (5, f"  {line}\nshort one"), (6, line[:-3])]
    got = {(r["doc_id"], r["line_no"]): (r["kept"], r["first_doc_id"]) for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {
        (1, 0): (True, 1), (1, 1): (True, 1), (1, 2): (True, 1), (2, 0): (False, 1), (2, 1): (True, 2),
        (3, 0): (False, 1), (4, 0): (False, 1), (5, 0): (False, 1), (5, 1): (False, 1), (6, 0): (True, 6),
    }


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_line_dedup_of_any_length_and_bound_against_brute_force(spark, edits):
    draw = np.random.default_rng(edits)
    typed = "the quick brown fox " * 30
    texts = ["a", "b", "ab", "abc", "short one", "short ono", "short", "é\U0001f600x", typed, typed[:99] + "X" + typed[100:300] + typed[301:], typed[:-3]]
    for length in (1, 2, 3, 5, 8, 13, 40):
        for _ in range(6):
            base = "".join(draw.choice(list("abcd"), length))
            texts.append(base)
            for _ in range(4):
                at, kind = int(draw.integers(0, len(base) + 1)), int(draw.integers(0, 3))
                base = base[:at] + ("" if kind == 0 else "e") + base[at + (kind != 1) :]
                texts.append(base)
    texts = [t.strip() for t in texts]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    near = lambda a, b: a == b or (abs(len(a) - len(b)) <= edits and distance(a, b) <= edits)
    want = {i: next(j for j in range(i + 1) if j == i or (t and texts[j] and near(texts[j], t))) for i, t in enumerate(texts)}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = line_dedup.line_dedup(frame, edits, 1).collect()
    assert {r["doc_id"]: r["first_doc_id"] for r in rows} == want
    assert all(r["kept"] == (want[r["doc_id"]] == r["doc_id"]) for r in rows)


def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.98 * len(rows)


def test_language_undetermined(docs):
    rows = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (3, 4, 5, 8))


def test_toxicity_on_held_out(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] and r["toxic"] for r in rows)
    assert right >= 0.95 * sum(r["predicted"] for r in rows) and right >= 0.85 * sum(r["toxic"] for r in rows)


def test_toxicity_learns_pairs():
    # Either term alone is harmless.
    present = [[], [0], [1], [0, 1]] * 60
    labels = np.array([float(p == [0, 1]) for p in present])
    bias, linear, factors = toxicity.fit(present, labels, 2)
    machine = toxicity.Machine({}, bias, linear, factors)
    assert machine.score([0, 1]) > 0.7 > 0.3 > max(machine.score([0]), machine.score([1]), machine.score([]))


def test_frequent_words_are_terms_of_their_own():
    look = toxicity.Lookup(None)
    plain = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))
    rare, often = set(look.of(f"{plain} badge badger")), set(look.of("badge badger now"))
    frequent = set(toxicity.terms("badg")[1])
    assert frequent <= often | {toxicity.terms("badg")[1][0]} and not frequent & rare
    assert toxicity.words("One one, TWO") == {"one": 2, "two": 1}


def test_toxicity_edges(spark, docs):
    labels = spark.createDataFrame([(1, 0), (6, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.toxicity(docs, labels.limit(0)).count() == len(ROWS)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


PAGE = """<html><head><title>t</title></head><body><header>Top</header><div class="cookie-notice">Accept</div>
<div id="wrap"><div class="post-%d content"><h1>Head&amp;line</h1><p>First  <b>bold</b> text&nbsp;here, long enough.<p>Second one<br>more.
<ul><li>item one<li>item two</ul><script>x<"</script><form><p>Your name</p></form></div>
<div class="sidebar"><p>Popular stories of the day, which are many</p></div>
<div id="comments"><p>A reader's long remark, longer than the article itself by far, going on and on and on and on.</p></div></div>
<footer>Foot</footer></body>"""
TEXT = "Head&line\n\nFirst bold text here, long enough.\n\nSecond one more.\n\nitem one\n\nitem two"


def test_html_extraction(spark):
    rows = [(i, "https://h.example/p", PAGE % i) for i in range(3)]
    rows += [(10, None, None), (11, "https://h.example/q", ""), (12, "nonsense", "plain words"), (13, "http://x.example", "<p>unclosed <!-- c"), (14, "http://x.example", "<nav>a</nav>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit(2))
    got = {r["page_id"]: r for r in html_text.extract(frame).collect()}
    assert all(got[i]["text"] == TEXT and got[i]["n_chars"] == len(TEXT) for i in range(3))
    assert [got[i]["text"] for i in (10, 11, 12, 13, 14)] == ["", "", "plain words", "unclosed", ""]
    assert html_text.extract(frame.limit(0)).count() == 0


def test_html_consensus_overrules_a_page(spark):
    usual = "<body><div class='a1'><p>{}</p></div><div class='b'><p>{}</p></div></body>"
    rows = [(i, "http://h.example/", usual.format("main text " * 20, "other")) for i in range(4)]
    rows.append((9, "http://h.example/", usual.format("short", "a long box of other text " * 9)))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.extract(frame).collect()}[9] == "short"


def test_html_takes_the_article_around_its_longest_block(spark):
    lead, body, more = "lead text " * 20, "body text of the page " * 140, "more of it " * 60
    links = "<a href='#'>elsewhere</a> " * 30
    shapes = {
        "nested lead": (f"<article><h1>Head</h1><div class='lead'>{lead}</div><div class='body'>{body}</div></article>", ["Head", lead, body]),
        "headline in main": (f"<main><h1>Head</h1><div class='content'>{body}</div></main><div class='x'>{more}</div>", ["Head", body]),
        "sections": (f"<main><section class='a'>{body}</section><section class='b'><h2>Two</h2>{more}</section></main>", [body, "Two", more]),
        "content container": (f"<div class='post-12'><div class='k1'>{lead}</div><div class='k2'>{body}</div></div><div>{more}</div>", [lead, body]),
        "deep": (f"<article><h1>Head</h1><div><div><div><div><div><div>{body}</div></div></div></div></div></div></article>", ["Head", body]),
        "noise": (f"<article><div class='body'>{body}</div><div class='related'>{more}</div></article>", [body]),
        "box longer than the article": (f"<article><div class='body'>{more}</div><div class='related-content'>{body}</div></article>", [more]),
        "comments in German": (f"<article><div class='body'>{body}</div><div id='kommentare'>{more}</div></article>", [body]),
        "opinions": (f"<article><div class='body'>{body}</div><div class='reader-opinions'>{more}</div></article>", [body]),
        "layout": (f"<div class='main-content with-sidebar'><p>{body}</p></div>", [body]),
        "links": (f"<main><article><h1>Head</h1><div class='body'>{body}</div></article><div>{links}</div></main>", ["Head", body]),
        "links in main": (f"<main><div class='k'>{body}</div><div>{links}</div></main>", [body]),
    }
    rows = [(i, f"http://{i // 3}.example/", f"<body><div>{shape}</div></body>") for i, (shape, _) in enumerate(s for s in shapes.values() for _ in range(3))]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, (name, (_, want)) in enumerate(shapes.items()):
        assert {got[3 * k + i] for i in range(3)} == {"\n\n".join(t.strip() for t in want)}, name


def test_html_in_any_state_takes_time_by_its_length(spark):
    whole = {
        "deep": ("<article><h1>H</h1>" + "<div>" * 100_000 + "text", "H\n\ntext"),
        "lists": ("<ul><article>" + "<div>" * 50_000 + "</ul>" * 50_000 + "x", "x"),
        "open quotes": ('<a "' * 250_000, None),
        "open tags": ("<a " * 330_000, None),
        "both quotes": ("<a \"'>" * 150_000, None),
        "open script": ("<p>x</p><script>" + "</script " * 100_000, "x"),
        "nested contents": ("<div class=content>x " * 30_000, "\n\n".join(["x"] * 30_000)),
        "late quote": ("<p>one <a href='x>two</a> three</p>", "one two three"),
        "no tag": ("<p>1 < 2 and <b", "1 < 2 and <b"),
        "sign in quotes": ("<p title='a > b'>text</p>", "text"),
    }
    rows = [(i, f"http://{i}.example/", source) for i, (source, _) in enumerate(whole.values())]
    rows += [rows[-1], (None, rows[-1][1], rows[-1][2])]
    begin = time.monotonic()
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert time.monotonic() - begin < 90 and len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    for i, (name, (_, want)) in enumerate(whole.items()):
        assert want is None or texts[i] == want, name


def test_language_of_any_order_of_rows(spark):
    draw = np.random.default_rng(2)
    words = {"aa": ["the", "and", "with", "house"], "bb": ["der", "und", "mit", "haus"]}
    rows = [(i, " ".join(draw.choice(words[lang], 12)), lang) for i, lang in enumerate(["aa", "bb"] * 100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first, second = (sorted(map(tuple, language.identify(f).collect())) for f in (frame.repartition(7), frame.orderBy(F.desc("text"))))
    assert first == second


def test_language_sample_takes_few_bytes_of_the_driver(spark):
    draw = np.random.default_rng(5)
    texts = ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz "), 4000)) for _ in range(200)]
    texts.append("a" * 70_000)  # a count of more than two bytes
    frame = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    want = [language.counts(t) for t in texts]
    grams = sum(np.count_nonzero(c) for c in want)
    idf = language.inverse_frequencies(frame)
    tracemalloc.start()
    drawn = language.sample(frame)
    taken = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    language.fit(drawn, idf)
    more = tracemalloc.get_traced_memory()[1] - taken
    tracemalloc.stop()
    assert taken < 16 * grams and more < 16 * grams
    got = [(np.frombuffer(r["at"], language.PLACES).tolist(), np.frombuffer(r["many"], language.TIMES).tolist()) for r in drawn]
    assert sorted(got) == sorted((np.flatnonzero(c).tolist(), c[c > 0].tolist()) for c in want)
    assert [got[i] for i in sorted(range(len(got)), key=lambda i: (drawn[i]["at"], drawn[i]["many"]))] == sorted(got)


def test_pipeline_keeps_one_of_each(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(i, f"plain words of number {i} " * 4, "en", "s", 1) for i in range(1, 25)]
    rows += [(50, text, "en", "s", 1), (51, text + " ", "en", "s", 1), (52, text + " more", "en", "s", 1), (53, "12 34", "en", "s", 1), (54, None, "en", "s", 1)]
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("in_mark", F.lit(1))
    left = docs
    for name, step in corpus_pipeline.STAGES[:4]:
        left = step(spark, left, "")
        assert left.columns == docs.columns, name
    ids = [r["doc_id"] for r in left.collect()]
    assert 50 in ids and not {51, 52, 53, 54} & set(ids) and ids.count(1) <= 3
    coded = corpus_pipeline.STAGES[4][1](spark, left, "").collect()
    assert sorted(r["doc_id"] for r in coded) == sorted(ids) and all(r["round_trip"] for r in coded)
    empty = docs.limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, "").count() == 0


@pytest.mark.parametrize("name", queries.ORACLES)
def test_against_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = db.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    ours = [tuple(r[n] for n in names) for r in queries.QUERIES[name](spark, SF).collect()]
    assert sorted(map(repr, ours)) == sorted(map(repr, want.fetchall()))
