"""Each operator against brute force, a library or a round trip, over small tables with odd rows."""

import collections
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelspark.llm import bpe, decontaminate, html_text, language, lines, near_dup, repeats, search, token_files, toxicity
from panelspark.llm.common import fold, table, word_hashes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
ODD = [None, "", " ", "\n\n", "---", "x", "Éa B", "don't I'LL \n\n a  b", "½ 12 ³ Ⅷ", "İstanbul ΟΔΟΣ", "a<|endoftext|>b", "\x00 \x1c\x1d x", "🙂🙂 ok", "a " * 3000]
SCHEMA = "doc_id long, text string, position int, word string, line int, hash string, ids_x string"


def frame(spark, texts, partitions=3):
    rows = [(i, t, 1, "w", 2, "h", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in table(spark, SF, "documents").orderBy("doc_id").collect()] + ODD


def test_word_hashes(texts):
    hashes, starts = word_hashes([t or "" for t in texts])
    known = {}
    for i, text in enumerate(texts):
        own = hashes[starts[i] : starts[i + 1]].tolist()
        assert len(own) == len(words(text))
        assert all(known.setdefault(w, h) == h for w, h in zip(words(text), own, strict=True))
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_bpe_equals_library(spark, texts, name):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.no_truncation()
    library.no_padding()
    for row in bpe.bpe_encode(frame(spark, texts), public_tokenizers.path(name)).collect():
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == want
        assert row.decoded == library.decode(want, skip_special_tokens=False)
    with pytest.raises(ValueError):
        bpe.bpe_encode(frame(spark, texts).withColumn("ids", F.lit(1)), public_tokenizers.path(name))


def test_token_files_round_trip(spark, texts, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    rows = frame(spark, texts)
    token_files.write_token_files(rows, f"{tmp_path}/files", path, partitions=3)
    got = {r.doc_id: r for r in token_files.read_token_files(spark, f"{tmp_path}/files").collect()}
    start = 0
    for i, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert (got[i].start, got[i].n_tokens, np.frombuffer(got[i].ids, "<u4").tolist()) == (start, len(want), want)
        start += len(want)


def test_packed_random_access():
    ids = np.array([0, 255, 256, 65535, 65536, 2**32 - 1, 7] * 400, np.uint32)
    packed = token_files.Packed(token_files.pack(ids))
    at = np.random.default_rng(0).integers(0, len(ids), 999)
    assert (packed.get(at) == ids[at]).all() and (packed.range(3, 2001) == ids[3:2001]).all()
    assert len(token_files.Packed(token_files.pack(ids[:0]))) == 0


def test_decontamination(spark):
    r = random.Random(2)
    vocabulary = ["a", "b", "the", "longword", "été"]
    items = ["", None, "a b", "the", *(" ".join(r.choice(vocabulary) for _ in range(n)) for n in (9, 10, 11, 14))]
    docs = ODD + [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60))) for _ in range(80)] + [items[-1] + "! " + items[-2]]
    item_rows = spark.createDataFrame([(f"i{i}", t, 1) for i, t in enumerate(items)] + [("copy", items[-1], 1)], "item_id string, text string, word int")
    windows = collections.defaultdict(set)
    for name, text in [(f"i{i}", t) for i, t in enumerate(items)] + [("copy", items[-1])]:
        w = words(text)
        for p in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[p : p + 10])].add(name)
    got = {x.doc_id: x for x in decontaminate.find_hits(frame(spark, docs), item_rows).withColumnRenamed("doc_key", "doc_id").withColumn("n_hit", decontaminate.hit_words("hits")).collect()}
    for i, text in enumerate(docs):
        w, covered, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    covered |= set(range(p, p + n))
                    found |= windows[tuple(w[p : p + n])]
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (len(w), len(covered), sorted(found))
    assert decontaminate.report(frame(spark, docs), item_rows.limit(0)).filter("contaminated").isEmpty()


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_BYTES, 0])
def test_grouping_of_hits_takes_no_words(spark, monkeypatch, most):
    """A row with all words of its document, for the document and each hit, is a multiple of the text in memory."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most)
    text = " ".join(f"w{i}" for i in range(40))
    items = spark.createDataFrame([("a", text), ("b", "w3 w4"), ("c", "w39")], "item_id string, text string")
    found = decontaminate.find_hits(frame(spark, ["x " * 30 + text, text, "w5 w3", "", None]), items)
    plan = found._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Aggregate":
        plan = plan.children().head()
    sent = plan.children().head().output().mkString(" ")
    assert "n_words" in sent and "w#" not in sent.replace("n_words", "")
    got = {r.doc_key: (r.n_words, len(r.hits), r["items"]) for r in found.collect()}
    assert got == {0: (70, 33, ["a", "b", "c"]), 1: (40, 33, ["a", "b", "c"]), 2: (2, 0, []), 3: (0, 0, []), 4: (0, 0, [])}


def test_near_duplicates(spark, texts):
    r = random.Random(5)
    base = [w for t in texts[:3] for w in words(t)][:200]
    near = [" ".join(w if r.random() > 0.004 else "changed" for w in base) for _ in range(12)]
    docs = texts + near + [" ".join(base).upper()]
    rows = frame(spark, docs)
    got = {x.doc_id: x.class_id for x in near_dup.classes(rows).collect()}
    idf = near_dup.inverse_frequencies(*near_dup.document_frequencies(rows))
    shingled = [set(zip(*(words(t)[k:] for k in range(5)))) or ({tuple(words(t))} if words(t) else set()) for t in docs]
    pairs = [(a, b) for b in range(len(docs)) for a in range(b) if shingled[a] and len(shingled[a] & shingled[b]) >= 0.5 * max(len(shingled[a]), len(shingled[b]))]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), s in zip(pairs, near_dup.similarities([docs[a] for a, _ in pairs], [docs[b] for _, b in pairs], idf), strict=True):
        if s >= near_dup.SIMILARITY:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert got == {i: root(i) for i in range(len(docs))}
    assert near_dup.keep_first(rows).count() == len(set(got.values()))
    assert near_dup.classes(rows.limit(0)).isEmpty()


def test_folded_weights_lose_no_link(spark):
    """Texts that share buckets though few are near: folded weights keep every pair of 0.8, and the classes stay right."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    docs = [" ".join(w if r.random() > 0.03 else f"x{r.random()}" for w in base) for _ in range(80)]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    idf = near_dup.inverse_frequencies(*near_dup.document_frequencies(rows))
    signed = near_dup.signatures(rows, idf).select("doc_id", "folded")
    both = signed.toDF("a", "fa").crossJoin(signed.toDF("b", "fb")).filter("a < b")
    kept = {(x.a, x.b) for x in both.filter(near_dup.may_be_near("fa", "fb")).collect()}
    pairs = [(a, b) for a in range(len(docs)) for b in range(a + 1, len(docs))]
    near = near_dup.similarities([docs[a] for a, _ in pairs], [docs[b] for _, b in pairs], idf)
    linked = {p for p, s in zip(pairs, near, strict=True) if s >= near_dup.SIMILARITY}
    assert linked and linked <= kept and len(kept) < len(pairs) / 2
    root = list(range(len(docs)))
    for _ in docs:
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    assert {x.doc_id: x.class_id for x in near_dup.classes(rows).collect()} == dict(enumerate(root))


def test_repeats(spark):
    r = random.Random(3)

    def noise(n):
        return "".join(r.choice("abcé \n") for _ in range(n))

    parts = [noise(150), noise(99), noise(100), noise(400), "a" * 350]
    docs = ["".join(r.choice([noise(r.randint(0, 80)), r.choice(parts), r.choice(parts)[: r.randint(50, 150)]]) for _ in range(r.randint(0, 6))) for _ in range(60)]
    docs += [docs[3], docs[5], "", None]
    seen, want = set(), {}
    for i, text in enumerate(docs):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                covered[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        want[i] = (len(data), sum(covered), bytes(x for x, c in zip(data, covered, strict=True) if not c))
    got = {x.doc_id: (x.n_bytes, x.n_removed, bytes(x.kept)) for x in repeats.remove_repeats(frame(spark, docs)).collect()}
    assert got == want
    assert repeats.remove_repeats(frame(spark, docs).limit(0)).isEmpty()


def test_repeats_inside_one_zone(spark):
    """Periodic runs that occur once in the corpus, or in equal zones only, also those hardly longer than a window."""
    r = random.Random(11)

    def noise(n):
        return "".join(chr(r.randint(33, 126)) for _ in range(n))

    docs = [noise(200) + (noise(period) * 130)[:size] + noise(200) for period in (1, 5, 11, 30, 47, 61, 62, 80) for size in (period + 100, period + 103, 400)]
    docs += [noise(150) + (noise(p) * 110)[: p + 101] + noise(150) for p in (1, 2, 3, 5, 7, 9) for _ in range(40)]
    docs += ["=" * 300, noise(50) + "=" * 300, " with" * 60 + noise(120), noise(120) + " with" * 60]
    seen, want = set(), {}
    for i, text in enumerate(docs):
        data, covered = text.encode(), bytearray(len(text))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                covered[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        want[i] = sum(covered)
    got = {x.doc_id: x.n_removed for x in repeats.remove_repeats(frame(spark, docs)).collect()}
    assert got == want


def test_lines(spark):
    r = random.Random(4)
    choice = ["x y", " z ", "", "long " * 45, "w " * 20, "q", "\t r", "u v w"]
    docs = ["\n".join(r.choice(choice) for _ in range(r.randint(0, 12))) for _ in range(80)] + [None, ""]
    seen, want = set(), {}
    for i, text in enumerate(docs):
        if text is None:
            want[i] = None
            continue
        split = text.split("\n")
        own = [k for k, x in enumerate(split) if x.strip(" \t\r")]
        gone = set()
        for at in range(len(own)):
            held = 0
            for n in range(1, min(lines.LINES, len(own) - at) + 1):
                held += len(split[own[at + n - 1]].split())
                if held >= lines.WORDS or n == lines.LINES:
                    window = tuple(split[k].strip(" \t\r") for k in own[at : at + n])
                    if window in seen:
                        gone |= set(own[at : at + n])
                    seen.add(window)
                    break
        want[i] = "\n".join(x for k, x in enumerate(split) if k not in gone)
    got = {x.doc_id: x.kept_text for x in lines.remove_lines(frame(spark, docs)).collect()}
    assert got == want


def test_lines_extended(spark):
    """Every line goes that lies in a run of lines which occurs earlier and holds a window."""
    r = random.Random(6)
    choice = ["x y", " z ", "", "long " * 45, "w " * 20, "q", "\t r", "u v w", "m " * 15, "n"]
    docs = ["long " * 45 + "\nshort\nx", "a\n" + "long " * 45 + "\nshort\ny"]
    docs += ["\n".join(r.choice(choice) for _ in range(r.randint(0, 10))) for _ in range(50)] + [None, ""]
    own = [[x.strip(" \t\r") for x in (t or "").split("\n") if x.strip(" \t\r")] for t in docs]

    def window(run):
        return any(sum(len(x.split()) for x in run[a:b]) >= lines.WORDS or b - a == lines.LINES
                   for a in range(len(run)) for b in range(a + 1, min(a + lines.LINES, len(run)) + 1))

    want = {}
    for i, late in enumerate(own):
        gone = set()
        for k, early in enumerate(own[: i + 1]):
            for shift in range(-len(late), len(early)):
                if k == i and shift >= 0:
                    continue
                at = 0
                while at < len(late):
                    end = at
                    while end < len(late) and 0 <= end + shift < len(early) and late[end] == early[end + shift]:
                        end += 1
                    if window(late[at:end]):
                        gone |= set(range(at, end))
                    at = max(end, at + 1)
        want[i] = sorted(gone)
    got = {x.doc_id: x.removed_lines for x in lines.remove_lines(frame(spark, docs), extend=True).collect()}
    assert got == want and want[1] == [1, 2]
    cut = [x.removed_lines for x in lines.remove_lines(frame(spark, docs)).filter("doc_id = 1").collect()]
    assert cut == [[1]]


def test_language(spark):
    docs = table(spark, SF, "documents")
    samples = language.learn(docs, fold("doc_id", 5) != 0)
    rows = language.identify(docs, samples).filter(fold("doc_id", 5) == 0).collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert right >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    odd = {r.text: r.lang_pred for r in language.identify(frame(spark, ODD), samples).collect()}
    assert odd[None] == odd[""] == odd["---"] == "und" != odd["x"]
    assert {r.lang_pred for r in language.identify(frame(spark, ODD), {}).collect()} == {"und"}
    parser = language.Parser(samples)
    for text in [r.text for r in rows[:3]]:
        bits, _ = parser.bits_per_character([text])
        for name, value in zip(parser.languages, bits[0], strict=True):
            sample, codes, phrases = parser.encode([samples[name]])[0].tobytes(), parser.encode([text])[0].tobytes(), 0
            for block in range(0, len(codes), language.BLOCK):
                part, at = codes[block : block + language.BLOCK], 0
                while at < len(part):
                    end = at
                    while end < len(part) and part[at : end + 1] in sample:
                        end += 1
                    at, phrases = max(end, at + 1), phrases + 1
            assert abs(value - phrases * np.log2(len(sample)) / len(codes)) < 1e-9


def test_toxicity(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.learn(docs, labels, fold("doc_id", 4) != 2)
    rows = toxicity.score_texts(docs.select("doc_id", "text"), model).join(labels, "doc_id").filter(fold("doc_id", 4) == 2).collect()
    assert sum((r.score >= toxicity.THRESHOLD) == bool(r.toxic) for r in rows) >= 0.97 * len(rows)
    reader = toxicity.Reader(model)
    clean, abuse, typo, quoted = reader.score(["", "you idiot", "you idiiot and pathetc loser", 'he said "you idiot" to me'])
    assert abuse > 0.3 and typo > 0.3 and clean < 0.3 and quoted < abuse
    assert toxicity.score_texts(frame(spark, ODD), model).count() == len(ODD)
    assert toxicity.learn(docs, labels.limit(0), F.lit(True)).odds == {}


def test_fuzzy_trie_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    r = random.Random(1)
    terms = {"".join(r.choice("abc") for _ in range(r.randint(3, 10))) for _ in range(40)}
    limits = {t: toxicity.edits_allowed(t) for t in terms}
    trie = toxicity.FuzzyTrie(limits)
    for _ in range(500):
        word = "".join(r.choice("abcd") for _ in range(r.randint(1, 11)))
        best = min(((distance(word, t), t) for t in terms if distance(word, t) <= limits[t]), default=None)
        assert trie.match(word) == (best and (best[1], best[0]))


def test_html():
    para = "<p>A fairly long paragraph, with commas, and words enough to count as text of the article.</p>"
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><div class='menu'><ul><li><a href=1>a</a></ul></div>"
        f"<div id=content><div class='cookie-notice'>We use cookies</div><h2>Head &amp; line</h2>{para}<div class='ad-box'>Buy</div>direct<br>text"
        f"<ul><li>one<li>two <b>bold</b></ul>{para}<section class='comments'><p>Nice, nice, nice, thanks</p></section><form>Name<input></form></div>"
        "<aside>side</aside><footer>foot</footer>"
    )
    line = "A fairly long paragraph, with commas, and words enough to count as text of the article."
    assert html_text.extract(page) == "\n".join(["Head & line", line, "direct text", "one", "two bold", line])
    assert [html_text.extract(x) for x in (None, "", "<p>x", "a &lt; b", "</p></div>x", "<script>x", "<!-- x")] == ["", "", "x", "a < b", "x", "", ""]
    assert html_text.extract("<div>" * 3000 + "deep") == "deep"


PARAGRAPHS = "<p>A long paragraph, with commas, that goes on for quite a while, so that it counts for an article.</p>" * 5


@pytest.mark.parametrize("wrapper", [
    "<div class='content-sidebar-wrap'>%s</div>", "<div class='no-sidebar'>%s</div>", "<div class='has-comments post'>%s</div>",
    "<div id='main-form'>%s</div>", "<form action=x>%s<input value=no></form>",
    "<body><div class='no-sidebar'><div class='has-comments'><form>%s</form><div class=comments><p>Nice, thanks</p></div></div></div>"
    "<div class=cookie-notice><p>We use cookies, and so on</p></div>",
])
def test_html_named_wrappers(wrapper):
    assert html_text.extract(wrapper % PARAGRAPHS).split("\n") == re.findall("<p>(.*?)</p>", PARAGRAPHS)


def test_html_notices_alone_are_no_article():
    assert html_text.extract("<div class=cookie-notice>" + PARAGRAPHS + "</div>") == ""


@pytest.mark.parametrize("unit", [
    "<a ", "a<b ", '<div class="x ', "<div>x", "<ul><li>x", "<b>", "<p><form><p>x", "<!-- ", "<form>", "<div class='no-sidebar'>", "<script></script ", "</p"])
def test_html_broken_megabyte_takes_seconds(unit):
    started = time.perf_counter()
    html_text.extract(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - started < 30


def test_html_pages(spark):
    pages = html_text.main_text(table(spark, SF, "pages")).collect()
    assert all(r.text and "<" not in r.text for r in pages)


def test_search(spark):
    rows = [(i, [((i * 7 + k * 3) % 11 - 5) / 10 for k in range(6)]) for i in range(70)]
    rows += [(70, None), (71, [0.1, None]), (72, [float("nan")] * 6), (73, [float("inf")] * 6), (80, [0.5]), (100, [])]
    data = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    got = collections.defaultdict(list)
    for r in search.top_k(search.quantise(data), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    whole = {r.vec_id: r.vector for r in search.quantise(data).collect()}
    assert sorted(whole) == [*range(70), 80, 100]
    for query in (i for i in whole if i % 20 == 0):
        want = sorted(((sum(a * b for a, b in zip(whole[query], v)), i) for i, v in whole.items() if i != query), key=lambda x: (-x[0], x[1]))[:20]
        assert got[query] == want


def best_rows(queries, rows, k):
    """The k best of (id, vector) rows for each query row."""
    out = []
    for query, q in queries:
        scored = [(-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != query]
        out += [(query, i, -score) for score, i in sorted(scored)[:k]]
    return sorted(out)


@pytest.mark.parametrize("most", [1, 3, 40, 10**5, 10**8])
def test_shards_hand_their_scores_on(monkeypatch, most):
    """Few queries and seeds at a time, equal vectors, ids that repeat, terms that hardly add."""
    monkeypatch.setattr(search, "QUERIES", 7)
    r = np.random.default_rng(most)
    for seeds, width, k, few in [(5, 0, 3, 1.0), (20, 1, 20, 1.0), (9, 6, 5, 1.0), (64, 12, 8, 0.1), (16, 40, 4, 0.05)]:
        monkeypatch.setattr(search, "SEED", seeds)
        ids, x = np.sort(r.integers(0, 300, 200)), r.integers(-most, most + 1, (200, width))
        x[:, 2:] *= r.random((200, max(width - 2, 0))) < few
        x[r.random(200) < 0.3] = x[0]
        shards = [(ids[at : at + 30], x[at : at + 30]) for at in range(0, 200, 30)]
        asked = r.random(200) < 0.2
        got = search.tile_top((ids[asked], x[asked]), shards, k)
        rows = list(zip(ids.tolist(), x.tolist(), strict=True))
        assert sorted(zip(*(c.tolist() for c in got), strict=True)) == best_rows([y for y, q in zip(rows, asked, strict=True) if q], rows, k)


def test_search_in_tiles_and_lanes(spark, monkeypatch):
    """Vectors are stored with as many bytes as their numbers need; parts are bounded and meet each other once."""
    for name, value in [("SHARD", 8), ("TILE_BYTES", (64, 128)), ("LANE_BYTES", (64, 400)), ("SEED", 4)]:
        monkeypatch.setattr(search, name, value)
    r = np.random.default_rng(4)
    rows = [(i, [float(c) for c in r.integers(-3, 3, 8)]) for i in range(300)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    blocks = search._blocks(search.quantise(data), 8, "shards")
    assert {x.kind for x in blocks.collect()} == {"<i2"} and max(len(x.grid) for x in blocks.collect()) == 8 * 8 * 2
    assert {x.kind for x in search._blocks(search.quantise(data, 1), 8, "shards").collect()} == {"<i1"}
    dealt, parts = search._deal(blocks, "lane", *search.LANE_BYTES)
    assert parts > 8 and 8 < len({x.lane for x in dealt.collect()}) <= parts and dealt.count() == blocks.count()
    got = search.top_k(search.quantise(data), F.col("vec_id") % 20 == 0, 6).collect()
    whole = [(i, [int(64 * c) for c in v]) for i, v in rows]
    assert sorted((x.query_id, x.vec_id, x.score) for x in got) == best_rows(whole[::20], whole, 6)
    assert all(sorted(x.rank for x in got if x.query_id == i) == [1, 2, 3, 4, 5, 6] for i in range(0, 300, 20))
    assert search.top_k(search.quantise(data), F.col("vec_id") < 0).isEmpty()


def test_words_need_the_library_model_only():
    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    library = encoder.library
    text = "The cafés, naïve 42 times: " + " ".join(f"wörd{i}ing, Привет don't" for i in range(20))
    want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    settled = [f"a{chr(c)}b {chr(c)}1{chr(c)}" for c in range(0x21, ord(token_files._SETTLED))]
    assert all(encoder.encode(x) == encoder._library(x) for x in settled if not token_files._runs(x))
    encoder.library = None  # whole calls cost three times the merging
    assert encoder.encode(text) == want


def test_pieces_of_a_batch_are_looked_up_once():
    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(5)
    parts = ["a", "s", "t", "m", "d", "re", "ve", "ll", "'", "'", "-", "1", "²", "ß", "Ж", "\xa0", "\x85", "\x1c", "\t", "\n", " ", " ", " ", "."]
    rare = ["東", "\u3000", "’", "é", "é", *encoder.special]
    texts = ["".join(r.choices(parts + rare * (i % 3 == 0), k=r.randint(0, 30))) for i in range(3000)] + ["", " ", "a ", " a", "\n", "a\n", "'", "'r", "'re", "x'll"]
    want = [encoder._library(x) for x in texts]
    ids, counts = encoder.encode_all(texts, b"\0\0\0\0")
    assert ids.tobytes() == b"".join(x + b"\0\0\0\0" for x in want) and (counts * 4 - 4).tolist() == list(map(len, want))
    asked = collections.Counter()
    known = encoder.by_piece

    class Asked(dict):
        def __getitem__(self, piece):
            asked[piece] += 1
            return known[piece]

    encoder.by_piece = Asked()
    assert encoder.encode_all(["it's red, it's blue", "blue it's"] * 200)[1].sum() == 2000
    assert set(asked) == {b"it", b"'s", b" red", b",", b" it", b" blue", b"blue"} and max(asked.values()) == 1


def test_repeats_forget_the_shuffles_of_finished_steps(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(repeats, "forget_shuffles", lambda session: steps.append(1))
    copy = "".join(chr(97 + i * i % 26) + str(i) for i in range(90))
    rows = spark.createDataFrame([(1, copy), (2, "x" + copy), (3, "y" * 300)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(rows).collect()}
    assert got == {1: 0, 2: len(copy), 3: 299} and len(steps) >= 9
