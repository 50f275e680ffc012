"""Small cases of the training-data operators, against brute force where there is some."""

import collections
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpuskit.llm import decontam, htmlcut, linededup, media, packing, quality, simhash, similar, suffix, tokenout, urlfilter
from corpuskit.llm.components import connected_components
from corpuskit.llm.tokens import DEFAULT_RANKS, encoding
from corpuskit.llm.xxh import xxh64_slices

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [(None, None, None, None, None), (1, "", "en", None, 0), (2, " \n\t ", None, "s", 3), (3, "x", "en", "s", 1), (3, "x", "en", "s", 1), (None, "x", None, None, None), (4, "é" * 70_000 + "\n" + "word " * 20_000, "fr", "s", 1)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)


# ---------------------------------------------------------------- SimHash


def slow_fingerprint(text, k):
    w = text.encode().lower().split()
    grams = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    votes = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if grams and votes[b] * 2 > len(grams))


def test_xxh64():
    rnd = random.Random(1)
    data = rnd.randbytes(5000)
    start = np.array([rnd.randrange(4000) for _ in range(500)])
    size = np.array([rnd.choice([rnd.randrange(70), rnd.randrange(990)]) for _ in range(500)])
    assert [int(x) for x in xxh64_slices(data, start, size, 42)] == [xxhash.xxh64_intdigest(data[a : a + n], 42) for a, n in zip(start, size)]


def test_fingerprints():
    texts = ["", "  ", "A", "a b", "The cat sat ON the mat É é", "x y z " * 400, "\x00 a\x0bb"]
    got = simhash.fingerprint_block([t.encode() for t in texts], 3)
    assert got.tolist() == [slow_fingerprint(t, 3) for t in texts]


@pytest.mark.parametrize("cap,refine", [(1024, 1 << 15), (4, 1 << 15), (4, 8)])
def test_links_equal_brute_force(spark, monkeypatch, cap, refine):
    monkeypatch.setattr(simhash, "CAP", cap)
    monkeypatch.setattr(simhash, "REFINE", refine)
    rnd = random.Random(2)
    values = {rnd.getrandbits(64) for _ in range(60)} | {0}
    for v in list(values)[:20]:
        for _ in range(6):
            w = v
            for b in rnd.sample(range(64), rnd.randrange(1, 6)):
                w ^= 1 << b
            values.add(w)
    values = sorted(values)
    fp = np.array(values, np.uint64).view(np.int64).tolist()
    found = connected_components(simhash.links(spark.createDataFrame([(x,) for x in fp], "fp bigint")))
    groups = collections.defaultdict(set)
    for r in found.collect():
        groups[r.component].add(r.node & (1 << 64) - 1)
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    want = collections.defaultdict(set)
    for v in values:
        want[root(v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_links_beside_a_hot_bucket(spark):
    """One partition value is shared by all, so thresholds move to partitions whose buckets hold one row."""
    rnd = random.Random(7)
    values = []
    for _ in range(600):
        v = sum(rnd.getrandbits(16) << 16 * i for i in range(1, 4))
        w = v
        for part in rnd.sample(range(1, 4), rnd.randrange(2, 4)):
            w ^= 1 << 16 * part + rnd.randrange(16)
        values += [v, w]
    values = np.array(sorted(set(values)), np.uint64)
    got = connected_components(simhash.links(spark.createDataFrame([(x,) for x in values.view(np.int64).tolist()], "fp bigint")))
    of = {r.node & (1 << 64) - 1: r.component for r in got.collect()}
    a, b = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3, 1))
    assert len(a) >= 590
    assert all(values[i] in of and of[values[i]] == of.get(values[j]) for i, j in zip(a.tolist(), b.tolist()))


def test_thresholds_sum_up():
    costs = [np.random.default_rng(i).random((5, 50)) for i in range(4)]
    t = simhash.allot(costs, 0)
    assert (t.sum(axis=1) == 0).all()
    cost = sum(costs[i][t[:, i] + 1, np.arange(50)] for i in range(4))
    every = [sum(costs[i][c[i]] for i in range(4)) for c in np.ndindex(5, 5, 5, 5) if sum(c) == 4]
    assert np.allclose(cost, np.min(every, axis=0))


def test_near_duplicates_odd_rows(spark):
    got = simhash.near_duplicates(spark.createDataFrame(ODD, DOCS)).collect()
    assert len(got) == len(ODD)
    by = {(r.doc_id, r.fp): r.component_id for r in got}
    assert by[(1, 0)] == 1 and by[(2, 0)] == 1 and by[(None, 0)] == 1
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


# ---------------------------------------------------------------- decontamination


def test_reparameterised_question(spark):
    item = "On Monday the farmer Alice sold 12 kg of apples to her neighbour Bob and then walked 5 km to the old market near the river"
    twin = item.replace("Alice", "Carol").replace("Bob", "Dave").replace("12", "40").replace(" 5 ", " 9 ")
    mixed = "On Monday the farmer Alice sold 12 kg of apples and 12 kg of pears before the market closed for the winter"
    broken = mixed.replace("12 kg of apples", "7 kg of apples").replace("12 kg of pears", "8 kg of pears")
    d = docs(spark, [(1, "before " + item + " after"), (2, twin), (3, "nothing of the kind here at all, only some words"), (4, broken), (None, item), (5, None), (6, "")])
    b = spark.createDataFrame([(1, item), (2, mixed), (3, None), (4, "too short")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontam.find_leaks(d, b).collect()}
    assert got == {(1, 1): "exact", (2, 1): "reparameterised", (None, 1): "exact"}
    assert sorted(r.doc_id or 0 for r in decontam.drop_leaks(d, b).collect()) == [0, 3, 4, 5, 6]
    assert decontam.find_leaks(d.limit(0), b).count() == 0
    assert decontam.find_leaks(d, b.limit(0)).count() == 0


def brute_leaks(texts, items, width=5, literals=3, coverage=0.8):
    """Every pair of windows of every document and item, by the words themselves."""
    coder = decontam.Coder()

    def forms(text):
        w = text.split()
        said, code, kind = decontam.template(w, np.array([len(w)]), coder)
        return [decontam.normal_form(x) for x in w], said.tolist(), code.tolist(), kind.tolist()

    out = {}
    for d, text in texts:
        dw, ds, dc, dk = forms(text)
        for i, item in items:
            iw, is_, ic, ik = forms(item)
            size = min(width, len(iw))
            met = []
            for p in range(len(dw) - size + 1):
                for q in range(len(iw) - size + 1):
                    if size and ds[p : p + size] == is_[q : q + size]:
                        met.append((p - q, q, []))
                    if size and dc[p : p + size] == ic[q : q + size] and ik[q : q + size].count(decontam.LITERAL) >= literals:
                        met.append((p - q, q, [(q + k, f"{ik[q + k]}:{iw[q + k]}", f"{dk[p + k]}:{dw[p + k]}") for k in range(size) if ik[q + k] != decontam.LITERAL]))
            covered = {}
            for line in {m[0] for m in met}:
                heard = collections.defaultdict(collections.Counter)
                for place, said, other in {x for m in met if m[0] == line for x in m[2]}:
                    heard[said][other] += 1
                bound = {s: (c.most_common(1)[0][0] if 2 * c.most_common(1)[0][1] > sum(c.values()) else "") for s, c in heard.items() if len(c) > 1}
                for _, q, pairs in (m for m in met if m[0] == line):
                    if all(bound.get(s, o) == o for _, s, o in pairs):
                        other = any(s != o for _, s, o in pairs)
                        for k in range(q, q + size):
                            covered[k] = min(covered.get(k, True), other)
            if iw and len(covered) / len(iw) >= coverage:
                out[(d, i)] = (len(covered), "reparameterised" if any(covered.values()) else "exact")
    return out


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(19)
    vocab = ["the", "farmer", "sold", "apples", "river", "Bob", "Alice", "12", "7", "kg", "km", "old", "market.", "near"]
    line = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, line(rnd.choice([2, 3, 5, 8, 20, 30]))) for i in range(12)]
    texts = [(i, line(rnd.randrange(40))) for i in range(20)]
    for i in range(40):
        w = rnd.choice(items)[1].split()
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        texts.append((100 + i, " ".join([line(rnd.randrange(6)), *w, line(rnd.randrange(6))])))
    got = {(r.doc_id, r.item_id): (r.n_covered, r.kind) for r in decontam.find_leaks(docs(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == brute_leaks(texts, items)
    assert len(got) > 20


# ---------------------------------------------------------------- URLs


def test_items_dense_in_slots(spark):
    """Numbers, units and names match word for word, however few literals there are, and short items are one window."""
    items = [(1, "What is 15 % of 240 ?"), (2, "3 14 15 92 65 35 89"), (3, "the poets Keats Byron Shelley Blake Clare Burns"), (4, "capital of France"), (5, "add 3 to seven")]
    d = docs(spark, [(i, f"some words before {t} and some behind") for i, t in items] + [(6, "3 14 15 92 66 35 88 and capital of Spain"), (7, "add 4 to seven"), (8, "they say capital of france.")])
    got = {(r.doc_id, r.item_id): r.kind for r in decontam.find_leaks(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {(i, i): "exact" for i, _ in items} | {(7, 5): "reparameterised", (8, 4): "exact"}


def test_one_edited_value_of_several(spark):
    """An edited number spoils the windows around it, as an edited word does, and not its whole diagonal."""
    item = " ".join(f"word{k}" for k in range(8)) + " 12 " + " ".join(f"term{k}" for k in range(10)) + " 12 " + " ".join(f"last{k}" for k in range(10)) + " 12 and so on to its very end"
    assert len(item.split()) == 38
    edited = item[::-1].replace("21", "31", 1)[::-1]
    moved = item.replace("12", "40", 2).replace("12", "41")
    d = docs(spark, [(1, edited), (2, item.replace("12", "40")), (3, moved)])
    got = {r.doc_id: (r.n_covered, r.kind) for r in decontam.find_leaks(d, spark.createDataFrame([(1, item)], "item_id bigint, text string")).collect()}
    assert got == {1: (37, "exact"), 2: (38, "reparameterised"), 3: (37, "reparameterised")}


def test_url_rules_and_parts(spark):
    rules = [urlfilter.Rule("allow", "com", "/"), urlfilter.Rule("block", "example.com", "/en/"), urlfilter.Rule("allow", "www.example.com", "/en/")]
    urls = ["HTTP://WWW.Example.com/en/1?x#y", "http://a.example.com/en/", "http://notexample.com/en/x", "http://x.com", "no scheme/", None, "", "http://é.com/É?q", "a://b://c/d"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    model = urlfilter.UrlModel(-1.0, ())
    got = [(r.host, r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(df, model, rules).orderBy("page_id").collect()]
    assert got[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[1] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert got[2] == ("notexample.com", "/en/x", "com/", "allow")
    assert got[3] == ("x.com", "", None, "allow")
    assert got[4:7] == [("", "", None, "allow")] * 3
    assert got[7][:2] == ("é.com", "/É")
    assert got[8][:2] == ("b:", "//c/d")


def test_url_trees_learn(spark):
    rnd = random.Random(4)
    good = [f"https://site{rnd.randrange(40)}.org/{rnd.choice(['a', 'news', 'blog'])}/{rnd.choice(['one', 'two-words', 'page'])}" for _ in range(300)]
    bad = [f"http://x{rnd.randrange(10**9)}.win/{rnd.randrange(10**9)}/{rnd.randrange(10**9)}?a=1&b={rnd.randrange(10**6)}&c=3" for _ in range(300)]
    rows = [(u, 0) for u in good] + [(u, 1) for u in bad]
    rnd.shuffle(rows)
    train, held = rows[:400], rows[400:]
    model = urlfilter.fit_urls(spark.createDataFrame(train, "url string, bad int"), rounds=4)
    got = urlfilter.filter_urls(spark.createDataFrame(held, "url string, bad int"), model, []).collect()
    assert np.mean([(r.verdict == "block") == (r.bad == 1) for r in got]) > 0.95
    one_class = urlfilter.fit_urls(spark.createDataFrame([("http://a", 1)], "url string, bad int"))
    assert one_class.trees == ()


# ---------------------------------------------------------------- media


def test_jpeg_round_trip():
    rnd = random.Random(3)
    payloads = [media.padded(rnd.randbytes(n)) for n in (0, 1, 192, 193, 5000)] + [media.padded(b"text " * 500), media.padded(bytes(192 * 8191 + 5))]
    for p, images in zip(payloads, media.decode(media.encode(payloads)), strict=True):
        assert b"".join(t.tobytes() for _, _, t in images) == p


def test_jpeg_with_ac_coefficients_and_colour():
    """A hand-made 4:2:0 image with AC coefficients: two MCUs, no restart markers."""
    dc_segment, dc = media.dht(0x00, (2, 2, 2))
    ac_symbols = [0x00, 0x01, 0xF0, 0x12]
    body = bytes([0x10]) + bytes([1, 1, 1, 1, *[0] * 12]) + bytes(ac_symbols)
    ac = media.canonical(ac_symbols, [1, 2, 3, 4])
    segment = b"\xff\xc4" + (len(body) + 2).to_bytes(2, "big") + body
    bits, want, last = "", [], 0
    rnd = random.Random(5)

    def put(code):
        return format(code[0], f"0{code[1]}b")

    for _ in range(2):
        for part in (0, 0, 0, 0, 1, 2):
            step = rnd.choice([-3, -1, 0, 1, 2])
            cat = abs(step).bit_length()
            bits += put(dc[cat]) + (format(step if step > 0 else step + (1 << cat) - 1, f"0{cat}b") if cat else "")
            bits += put(ac[0x01]) + "1" + put(ac[0xF0]) + put(ac[0x12]) + "10" + put(ac[0x00])
            if part == 0:
                last += step
                want.append(last)
    bits += "1" * (-len(bits) % 8)
    scan = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    quant = b"\xff\xdb\x00\x43\x00" + bytes([16] * 64)
    frame = b"\xff\xc0" + (17).to_bytes(2, "big") + bytes([8, 0, 16, 0, 32, 3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    sos = b"\xff\xda" + (12).to_bytes(2, "big") + bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])
    data = b"\xff\xd8\xff\xfe\x00\x04hi" + quant + frame + dc_segment + segment + sos + scan + b"\xff\xd9"
    ((width, height, thumb),) = media.decode([data])[0]
    grid = np.array(want).reshape(2, 2, 2).transpose(1, 0, 2).reshape(2, 4)
    assert (width, height) == (32, 16) and (thumb == np.clip(grid * 2 + 128, 0, 255)).all()


def test_media_odd_rows(spark):
    got = media.media_features(media.with_media(spark.createDataFrame(ODD, DOCS))).collect()
    assert len(got) == len(ODD)
    assert {r.n_bytes for r in got} == {len((r[1] or "").encode()) for r in ODD}
    broken = spark.createDataFrame([(1, bytearray(b"\xff\xd8 no image")), (2, None)], "doc_id bigint, media binary")
    assert [r.feature for r in media.media_features(broken).collect()] == [None, None]


# ---------------------------------------------------------------- suffix arrays


def test_suffix_array_and_prefixes():
    rnd = random.Random(5)
    for _ in range(150):
        n, a = rnd.randrange(60), rnd.choice([1, 2, 3, 26])
        text = bytes(rnd.randrange(a) + 97 for _ in range(n)) if rnd.random() < 0.7 else b"abcab" * rnd.randrange(9)
        array = suffix.suffix_array(np.frombuffer(text, np.uint8).astype(np.int64) + 1)
        assert array.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        for k, shared in enumerate(suffix.common_prefixes(text, array).tolist()[1:], 1):
            x, y = text[array[k - 1] :], text[array[k] :]
            assert shared == next((m for m in range(min(len(x), len(y))) if x[m] != y[m]), min(len(x), len(y)))


def brute_removal(rows, w):
    counts = collections.Counter(t[i : i + w] for _, t in rows for i in range(len(t) - w + 1))
    out = []
    for i, t in rows:
        gone = [False] * len(t)
        for k in range(len(t) - w + 1):
            if counts[t[k : k + w]] > 1:
                gone[k : k + w] = [True] * w
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("crowd,gram", [(1000, 64), (3, 8)])
def test_repeats_equal_brute_force(spark, monkeypatch, crowd, gram):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    monkeypatch.setattr(suffix, "GRAM", gram)
    rnd, w = random.Random(6), 40
    base = [bytes(rnd.choice(b"abcd ") for _ in range(rnd.randrange(300))) for _ in range(30)]
    line = bytes(rnd.choice(b"xyz") for _ in range(37))
    rows = [(100, b""), (101, b"ab" * 100)]
    for i in range(80):
        t = rnd.choice(base)
        if rnd.random() < 0.5:
            k = rnd.randrange(len(t) + 1)
            t = t[:k] + line + t[k:]
        rows.append((i, t))
    got = suffix.remove_repeats(docs(spark, [(i, t.decode()) for i, t in rows]), min_len=w).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_removal(rows, w)


def test_repeats_with_shared_ids(spark):
    """Rows of one id with different texts, null ids and repeated rows keep their own spans."""
    rnd = random.Random(16)
    a, b, c = ("".join(rnd.choice("abcdefgh ") for _ in range(n)) for n in (255, 255, 300))
    rows = [(7, a), (7, b), (8, a), (None, c), (None, b[:210] + "!"), (9, "z" + c), (9, "z" + c)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffix.remove_repeats(docs(spark, rows)).collect())
    assert got == sorted([("7", 255, 255), ("7", 255, 210), ("8", 255, 255), ("None", 300, 300), ("None", 211, 210), ("9", 301, 301), ("9", 301, 301)])


def test_repeats_around_a_crowded_passage(spark, monkeypatch):
    """A passage shorter than a window in very many surroundings goes through all levels; some windows repeat as a whole."""
    monkeypatch.setattr(suffix, "CROWD", 10)
    rnd = random.Random(17)
    passage = "".join(rnd.choice("abcde ") for _ in range(150))
    rows = []
    for i in range(70):
        left, right = ("".join(rnd.choice("vwxyz") for _ in range(rnd.randrange(120))) for _ in range(2))
        rows.append((i, left + passage + right))
    rows += [(100 + i, rows[i][1][5:]) for i in range(0, 20, 3)]
    got = suffix.remove_repeats(docs(spark, rows), min_len=200).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_removal([(i, t.encode()) for i, t in rows], 200)


def test_repeats_odd_rows(spark):
    got = suffix.remove_repeats(spark.createDataFrame(ODD, DOCS), min_len=200).collect()
    assert len(got) == len(ODD) and {r.n_removed for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert suffix.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


# ---------------------------------------------------------------- HTML


def test_main_text():
    page = """<html><head><title>T</title></head><body><header>Site</header><nav>a b</nav><div class="cookie-notice">We use</div><main><article><h1>Head</h1>
    <p>One <a href=x>two</a> three &amp; four.<p>Five&nbsp;six<br>seven<aside>side</aside><div class="ad-slot">Buy</div><form><label>Name</label></form><ul><li>item one<li>item two</ul>
    <script>x="</article>"</script><section id="comments"><article class="comment">nice</article></section></article></main><footer>f</footer>"""
    assert htmlcut.main_text(page)[0] == "Head\nOne two three & four.\nFive six seven\nitem one\nitem two"
    for odd in ("", "<", "<p", "<!-- x", "a < b", "<p>x " * 2000, '<a "' * 500, "</p></div>text", "<style>x", "<b>\x00</b>"):
        htmlcut.main_text(odd)


@pytest.mark.parametrize("page", ["<b>" * 60_000 + "</i>" * 60_000, "<ul><li><ul>" + "<b>" * 50_000 + "<li></li>" * 50_000, '<a "x' * 50_000 + ">", "<p>x" * 20_000, "<td>a<table>" * 10_000, "<b>" * 20_000 + "<div></div>x" * 20_000])
def test_parsing_is_linear(page):
    began = time.time()
    htmlcut.main_text(page)
    assert time.time() - began < 10


def test_pages_are_cut_at_the_minimum():
    """Whole pages: the labels are those of the cheapest of all labellings."""
    rnd = random.Random(18)
    for _ in range(60):
        parts = [rnd.choice(["<p>{}</p>", "<div>{}</div>", "<li><a href=x>{}</a></li>", "<h2>{}</h2>", "<nav>{}</nav>", "<div><p>{}</p></div>"]).format(" ".join(["word,"] * rnd.randrange(1, 25))) for _ in range(rnd.randrange(1, 9))]
        weights = np.array([rnd.uniform(-1, 1) for _ in htmlcut.FEATURES])
        blocks, marks, cost, edges = htmlcut.cut_problem("".join(parts), weights)

        def value(side):
            return sum(max(c, 0) if not s else max(-c, 0) for c, s in zip(cost, side)) + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(value([bool(m >> i & 1) for i in range(len(blocks))]) for m in range(1 << len(blocks)))
        assert abs(value(htmlcut.min_cut(cost, edges)) - best) < 1e-6


def test_cut_moves_blocks_to_their_neighbours():
    """A weak block among strong ones takes their side, and not its own."""
    weights = np.zeros(len(htmlcut.FEATURES))
    weights[[htmlcut.FEATURES.index(f) for f in ("bias", "log_words")]] = -2.0, 1.0
    page = "".join(f"<p>{'word ' * n}</p>" for n in (60, 50, 5, 40, 60))
    text, n, kept, moved = htmlcut.main_text(page, weights)
    assert (n, kept, moved) == (5, 5, 1)


def test_fitted_weights_judge_pages_without_marks(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = htmlcut.fit_weights(pages, max_pages=200)
    right = total = 0
    for r in pages.collect():
        bare = re.sub(r' (class|id)="[^"]*"', "", re.sub(r"<(/?)(article|nav|footer|aside|header|main)\b[^>]*>", r"<\1div>", r.html or ""))
        truth = set(htmlcut.main_text(r.html or "", weights)[0].split("\n"))
        blocks, _, kept = htmlcut.labelled_blocks(bare, weights)
        right += sum(k == (b.text in truth) for b, k in zip(blocks, kept))
        total += len(blocks)
    assert right > 0.95 * total
    assert (htmlcut.fit_weights(pages.limit(0)) == np.array(list(htmlcut.UNFITTED.values()))).all()


def test_min_cut_is_minimal():
    rnd = random.Random(7)
    for _ in range(40):
        n = rnd.randrange(1, 8)
        cost = [rnd.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rnd.uniform(0, 2)) for a in range(n) for b in range(a) if rnd.random() < 0.5]

        def value(side):
            return sum(max(c, 0) if not s else max(-c, 0) for c, s in zip(cost, side)) + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(value([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert abs(value(htmlcut.min_cut(cost, edges)) - best) < 1e-6


def test_capitals_and_digits_of_whole_blocks():
    """Shares count every character of a block, far behind its beginning too, in any script."""
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(s) for _ in range(n)) for s in ("abC1", "éÉßΩω٣²中", "aÉ9 Ⅷ字𝐀") for n in (1, 399, 400, 401, 5000)]
    texts = [" ".join(t.split()) or "x" for t in [*texts, "a" * 400 + "BC12" * 600, "a" * 400 + "ÀЖ٣²" * 600]]
    elements, blocks = htmlcut.blocks_of("".join(f"<p>{t}</p>" for t in texts))
    assert [b.text for b in blocks] == texts
    at = [htmlcut.FEATURES.index(f) for f in ("capitals", "digits")]
    for t, row in zip(texts, htmlcut.features(elements, blocks), strict=True):
        assert [row[k] for k in at] == [sum(map(kind, t)) / len(t) for kind in (str.isupper, str.isdigit)]


def test_extraction_odd_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "mine"), (None, None, "", None), (3, "u", "<p>Hi there</p>", "x")], "page_id bigint, url string, html string, text string")
    assert [(r.page_id, r.text, r.n_chars) for r in htmlcut.extract_main_text(df).collect()] == [(1, "", 0), (None, "", 0), (3, "Hi there", 8)]


# ---------------------------------------------------------------- packing and token output


def test_buckets_are_optimal():
    rnd = random.Random(8)
    for _ in range(30):
        lengths = sorted(rnd.sample(range(1, 60), rnd.randrange(1, 9)))
        counts = [rnd.randrange(1, 20) for _ in lengths]
        k = rnd.randrange(1, 5)

        def waste(ends):
            return sum(c * (min(e for e in ends if e >= l) - l) for l, c in zip(lengths, counts))

        import itertools

        best = min(waste([*some, lengths[-1]]) for m in range(min(k, len(lengths))) for some in itertools.combinations(lengths[:-1], m))
        ends = packing.best_buckets(np.array(lengths), np.array(counts), k)
        assert len(ends) <= k and ends[-1] == lengths[-1] and waste(ends) == best


def test_packing_keeps_every_token(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice([1, 5, 30, 100, 1000])) for i in range(300)] + [(7, 5), (None, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint"), max_len=128, buckets=3, token_budget=512).collect()
    assert sum(r.n_tokens for r in got) == sum(n or 1 for _, n in rows)
    assert all(r.n_tokens <= r.bucket_len <= 128 for r in got)
    for (_, bucket), members in collections.Counter((r.batch_id, r.bucket_len) for r in got).items():
        assert members <= max(1, 512 // bucket)
    assert len({(r.batch_id, r.slot) for r in got}) == len(got)
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, n_tokens bigint")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_feistel_is_a_permutation(n):
    assert sorted(tokenout.feistel(np.arange(n), n, 7).tolist()) == list(range(n))


def test_token_output_round_trip(spark, tmp_path):
    rows = [(1, "hello the world " * 50), (2, ""), (None, None), (3, "é" * 300), (3, "é" * 300)]
    out = f"file://{tmp_path}/out"
    got = tokenout.write_tokens(docs(spark, rows), length=16, shard_bytes=256, out_dir=out).collect()
    records = list(tokenout.read_slots(out))
    assert len(records) == len(got) == tokenout.read_manifest(out)["sequences"]
    enc, texts = encoding(DEFAULT_RANKS), collections.Counter()
    by = collections.defaultdict(dict)
    for r in got:
        by[(r.doc_id)].setdefault(r.seq, []).append(records[r.slot][: r.n_tokens].tolist())
    for i, pieces in by.items():
        text = next(t for k, t in rows if k == i) or ""
        assert sum((pieces[s][0] for s in sorted(pieces)), []) == enc.encode_ordinary(text) + [50256]
        texts[i] = len(pieces[0])
    assert texts[3] == 2
    assert [x.tolist() for x in tokenout.read_slots(out, 3, 9)] == [x.tolist() for x in records[3:9]]
    assert tokenout.write_tokens(docs(spark, []), out_dir=f"{tmp_path}/none").count() == 0


def test_slots_follow_keys_and_not_partitions(spark, tmp_path):
    rnd = random.Random(12)
    rows = [(rnd.choice([None, i, i // 2]), "word " * rnd.randrange(90)) for i in range(200)] + [(5, "same text")] * 9
    outs = []
    for n, cuts in enumerate((1, 5)):
        rnd.shuffle(rows)
        out = f"file://{tmp_path}/{n}"
        got = tokenout.write_tokens(spark.createDataFrame(spark.sparkContext.parallelize([(i, t, "en", "s", 0) for i, t in rows], cuts), DOCS), length=16, shard_bytes=512, out_dir=out)
        outs.append((sorted(((str(r.doc_id), r.seq, r.slot, r.record_crc32) for r in got.collect())), [x.tolist() for x in tokenout.read_slots(out)]))
    assert outs[0][1] == outs[1][1]
    same = lambda rows_: sorted((i, s, c) for i, s, _, c in rows_)
    assert same(outs[0][0]) == same(outs[1][0])
    assert sorted(r[2] for r in outs[0][0]) == list(range(len(outs[0][1])))
    assert {r[2]: r[0] for r in outs[0][0]} == {r[2]: r[0] for r in outs[1][0]}


def test_slots_equal_a_plain_version(spark, tmp_path):
    """Numbers in the order of ids, permuted, ranked, and cut into ranges."""
    rnd = random.Random(20)
    rows = [(i, "some words " * rnd.randrange(40) + str(i)) for i in range(50)]
    rnd.shuffle(rows)
    length, key, out = 16, 5, f"file://{tmp_path}/out"
    got = {(r.doc_id, r.seq): (r.slot, r.shard, r.n_tokens) for r in tokenout.write_tokens(docs(spark, rows), length=length, key=key, shard_bytes=20 * 2 * length, out_dir=out).collect()}
    enc, at, permuted = encoding(DEFAULT_RANKS), 0, {}
    most = sum(len(t.encode()) // length + 1 for _, t in rows)
    for i, t in sorted(rows):
        n = len(enc.encode_ordinary(t)) + 1
        for seq in range(-(-n // length)):
            permuted[(i, seq)] = (int(tokenout.feistel(np.array([at + seq]), most, key)[0]), min(length, n - seq * length))
        at += len(t.encode()) // length + 1
    order = sorted(permuted, key=permuted.get)
    assert got == {k: (s, permuted[k][0] // 20, permuted[k][1]) for s, k in enumerate(order)}


# ---------------------------------------------------------------- quality


def test_quality_on_held_out_rows(spark):
    rnd = random.Random(10)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(200)]

    def text(good):
        w = [rnd.choice(vocab) for _ in range(60)]
        if not good:
            w = [x + "***" for x in w] if rnd.random() < 0.5 else w[:30] + ["moron"] + w[30:]
        return " ".join(w)

    rows = [(i, text(i % 4 > 0), "en", f"s{i % 3}", 0) for i in range(800)]
    d = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(500)], "doc_id bigint, quality int, toxic int")
    model = quality.fit_classifier(quality.labelled_sample(d, labels))
    got = [r for r in quality.score(d, model).collect() if r.doc_id >= 500]
    assert np.mean([r.keep == (r.doc_id % 4 > 0) for r in got]) > 0.95
    odd = quality.score(spark.createDataFrame(ODD, DOCS), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.quality_score <= 1 for r in odd)
    none = quality.fit_classifier(d.limit(0).withColumn("good", F.lit(1)))
    assert none.words == {} and quality.score(d.limit(0), none).count() == 0


def test_group_rates_shrink(spark):
    model = quality.Classifier(0.0, {b"good": 3.0, b"bad": -3.0}, (0.0,) * 9, (0.0,) * 9, (1.0,) * 9)
    rows = [(i, "good" if i % 10 else "bad", "en", "big", 0) for i in range(200)] + [(1000 + i, "bad", "en", "poor", 0) for i in range(100)] + [(2000, "bad", "en", "tiny", 0)]
    got = {r.source: r.host_rate for r in quality.score(spark.createDataFrame(rows, DOCS), model).collect()}
    assert got["poor"] < got["tiny"] < got["big"]


def test_scores_equal_a_plain_version(spark):
    """Group sums, moment estimates, shrinkage and the document's own evidence taken out, one document at a time."""
    rnd = random.Random(21)
    model = quality.Classifier(0.2, {b"good": 2.0, b"bad": -1.5, b"fair": 0.5}, (0.0,) * 9, (0.0,) * 9, (1.0,) * 9)
    rows = [(i, " ".join(rnd.sample(["good", "bad", "fair", "x", "y"], 2)), rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "c", None]), 0) for i in range(120)]
    p = {r[0]: 1 / (1 + np.exp(-model.evidence(r[1].encode()))) for r in rows}
    rate = (sum(p.values()) + 0.5) / (len(rows) + 1)

    def strength(groups):
        n, k, c = (np.array(x, float) for x in zip(*groups))
        spread, noise = (n * (k / n - c) ** 2).sum(), (c * (1 - c)).sum()
        between = (spread - noise * (len(n) - 1) / len(n)) / (n.sum() - (n**2).sum() / n.sum())
        return min(1e6, max(1.0, (n * c * (1 - c)).sum() / n.sum() / between - 1)) if between > 0 else 1e6

    hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
    for i, _, lang, source, _ in rows:
        hosts[source].append(p[i])
        paths[source, lang].append(p[i])
    mh = strength([(len(v), sum(v), rate) for v in hosts.values()])
    host_rate = {h: (sum(v) + mh * rate) / (len(v) + mh) for h, v in hosts.items()}
    mp = strength([(len(v), sum(v), host_rate[h]) for (h, _), v in paths.items()])
    for r in quality.score(spark.createDataFrame(rows, DOCS), model).collect():
        h, q, own = hosts[r.source], paths[r.source, r.lang], p[r.doc_id]
        host = (sum(h) - own + mh * rate) / (len(h) - 1 + mh)
        path = (sum(q) - own + mp * host) / (len(q) - 1 + mp)
        total = np.log(own / (1 - own)) + np.log(path / (1 - path)) - np.log(rate / (1 - rate))
        assert abs(r.quality_score - 1 / (1 + np.exp(-total))) < 1e-9 and abs(r.host_rate - host_rate[r.source]) < 1e-9


# ---------------------------------------------------------------- lines


def brute_lines(rows):
    strip = " \t\n\x0b\f\r"
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(strip).translate(fold)
    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and i != max(held[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_lines_equal_brute_force(spark):
    rnd = random.Random(11)
    common = ["A line of Forty characters or more, É and é %d" % i for i in range(6)] + ["É" * 39, "é" * 40, "É" * 40, "short", "", "x" * 39]
    rows = [(i, "\n".join(rnd.choice(["", " ", "\t"]) + (c.upper() if rnd.random() < 0.3 and c.isascii() else c) for c in rnd.choices(common, k=rnd.randrange(6)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n")]
    got = linededup.dedup_lines(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got) == brute_lines(rows)


def test_lines_odd_rows(spark):
    line = "z" * 50
    rows = ODD + [(i, line, "en", "s", 1) for i in range(10, 16)] + [(None, line, None, None, 1), (12, line, "en", "s", 1)]
    got = linededup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    assert sorted(r.doc_id or -1 for r in got if r.text == line) == [15]
    assert linededup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_near_stage_equals_brute_force(spark):
    """Edited copies on both sides of similarity 0.8, against all pairs."""
    import corpus_pipeline

    rnd, rows = random.Random(11), []
    for _ in range(40):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randrange(3, 200))]
        rows.append(" ".join(base))
        for _ in range(4):
            copy = list(base)
            for _ in range(rnd.randrange(0, 1 + len(base) // 25)):
                copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(5000)}"
            rows.append(" ".join(copy))
    rows += ["common words of a passage that many texts hold " * 3 + t for t in rows[::5]] + ["", " "]
    grams = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := t.split()) else set() for t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(grams):
        for j in range(i):
            if 5 * len(a & grams[j]) >= 4 * len(a | grams[j]):
                u, v = sorted((find(i), find(j)))
                root[v] = u
    got = corpus_pipeline.near_stage(spark, docs(spark, list(enumerate(rows))), "").collect()
    assert sorted(r.doc_id for r in got) == [i for i in range(len(rows)) if root[i] == i]


def test_near_stage_null_and_shared_ids(spark):
    import corpus_pipeline

    one, two = "the first of two texts that have no word in common", "another one about something else and far from it"
    rows = [(None, one), (None, two), (None, two), (7, one), (7, two), (7, two), (8, two)]
    got = corpus_pipeline.near_stage(spark, docs(spark, rows), "").collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted([("None", one), ("None", two), ("None", two), ("7", one), ("7", two)])


# ---------------------------------------------------------------- odd input for all, and the stages of the pipeline


CLASH = ("evidence keep n_lines n_dropped fp component_id p n k id __id __text __t1 __lost __url __host __path __n0 __rule __h __p __k g key hash text_hash slot seq shard n_tokens "
         "media n_bytes rule verdict label good item_id __leak leak c0 c1 c7 weight t").split()  # fmt: skip


def clashing(df):
    """The table with columns of all names that operators use inside, each with a value of its own."""
    return df.withColumns({c: F.concat(F.lit(f"{c}-"), F.col(df.columns[0]).cast("string")) for c in CLASH if c not in df.columns})


def same_columns(df, id_col, skip=()):
    """Passed-through columns still hold what they held."""
    return all(r[c] == (None if r[id_col] is None else f"{c}-{r[id_col]}") for r in df.collect() for c in CLASH if c in df.columns and c not in skip)


def test_clashing_columns_of_all_operators(spark, tmp_path):
    rows = [(i, f"text number {i} of a few " * (i % 5 + 1), "en", f"s{i % 3}", 0) for i in range(30)] + ODD
    d = clashing(spark.createDataFrame(rows, DOCS))
    n = len(rows)
    assert simhash.near_duplicates(d).count() == n
    bench = clashing(spark.createDataFrame([(1, rows[3][1])], "item_id bigint, text string"))
    leaks = decontam.find_leaks(d, bench)
    assert leaks.columns == ["doc_id", "item_id", "n_words", "n_covered", "coverage", "kind"] and leaks.count() >= 1
    kept = decontam.drop_leaks(d, bench)
    assert kept.columns == d.columns and same_columns(kept, "doc_id")
    assert suffix.remove_repeats(d).count() == n
    assert media.media_features(media.with_media(d)).count() == n
    assert packing.pack(packing.token_counts(d)).count() >= n
    assert tokenout.write_tokens(d, length=16, out_dir=f"{tmp_path}/clash").count() >= n
    lines = linededup.dedup_lines(d)
    assert lines.count() == n and same_columns(lines, "doc_id", ("n_lines", "n_dropped"))
    model = quality.fit_classifier(quality.labelled_sample(d, spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id bigint, quality int, toxic int")))
    scored = quality.score(d, model)
    assert scored.count() == n and same_columns(scored, "doc_id", ("evidence", "keep"))
    pages = clashing(spark.createDataFrame([(i, f"http://a{i}.com/x", f"<p>Some words of page {i}, long enough to stay here.</p>") for i in range(5)], "page_id bigint, url string, html string"))
    found = urlfilter.filter_urls(pages, urlfilter.UrlModel(0.0, ()), [urlfilter.Rule("allow", "com", "/")])
    assert found.where("rule = 'com/'").count() == 5 and same_columns(found, "page_id", ("rule", "verdict"))
    texts = htmlcut.extract_main_text(pages)
    assert texts.where("n_chars > 0").count() == 5 and same_columns(texts, "page_id", ("text",))


def test_very_long_texts(spark, tmp_path):
    """One text of a few megabytes, words and lines of any length."""
    rnd = random.Random(22)
    long = "".join(rnd.choices("abcdefghij \n", k=1_500_000)) + "x" * 300_000
    d = docs(spark, [(1, long), (2, "short"), (3, long[1000:])])
    assert {r.doc_id for r in simhash.near_duplicates(d).collect()} == {1, 2, 3}
    assert {r.id: r.component for r in similar.similar_components(d).collect()}.keys() == {1, 2, 3}
    parts = {r.id: r.component for r in similar.similar_components(d).collect()}
    assert parts[1] == parts[3] != parts[2]
    got = {r.doc_id: r.n_removed for r in suffix.remove_repeats(d).collect()}
    assert got == {1: len(long) - 1000, 2: 0, 3: len(long) - 1000}
    assert decontam.find_leaks(d, spark.createDataFrame([(1, " ".join(long.split()[500:540]))], "item_id bigint, text string")).count() == 2
    assert packing.pack(packing.token_counts(d)).agg(F.sum("n_tokens")).first()[0] == sum(len(encoding(DEFAULT_RANKS).encode_ordinary(t)) + 1 for t in (long, "short", long[1000:]))
    assert tokenout.write_tokens(d, out_dir=f"{tmp_path}/long").agg(F.sum("n_tokens")).first()[0] > 500_000
    assert linededup.dedup_lines(d).count() == 3
    page = spark.createDataFrame([(1, "<article><p>" + "word " * 300_000 + "</p></article>")], "page_id bigint, html string")
    assert htmlcut.extract_main_text(page).first().n_chars == 5 * 300_000 - 1


def test_stages_on_odd_rows(spark, tmp_path):
    """Null in any column, empty and very long texts, repeated rows, extra columns, and empty tables, stage by stage."""
    import corpus_pipeline

    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)] + [(None, 1, 0), (4, None, None)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, "a question of nine words that a document leaks"), (None, None), (2, "")], "item_id bigint, text string")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    good = [(i, f"plain words of document {i} about river {i * 7} and hill {i * 11} " * 3, "en", f"s{i % 2}", 1) for i in range(5, 40)]
    d = clashing(spark.createDataFrame([*good, *ODD, (50, "before a question of nine words that a document leaks after", "en", "s", 1)], DOCS))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, str(tmp_path))
        empty = stage(spark, d.limit(0), str(tmp_path))
        assert empty.count() == 0 and empty.columns == out.columns, name
        if name == "packing":
            assert out.select("doc_id").distinct().count() == d.select("doc_id").distinct().count()
            continue
        assert out.columns == d.columns and same_columns(out, "doc_id"), name
        before, after = (collections.Counter((r.doc_id, r.text) for r in x.select("doc_id", "text").collect()) for x in (d, out))
        if name == "line dedup":
            assert after == before, name  # no line of forty characters is in five documents
        elif name == "SimHash near-dedup":
            assert after == before - collections.Counter([(3, "x"), (2, " \n\t ")]), name
        elif name == "benchmark decontamination":
            assert after == before - collections.Counter([d_ for d_ in before if d_[0] == 50]), name
        else:
            assert not after - before, name


def test_stage_rows_equal_plain_versions(spark):
    """Line, near-duplicate and leak stages on the smallest tables, against one pass of plain Python each."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.line_stage(spark, d, sf).collect())
    assert got == sorted((i, t) for i, _, _, t in brute_lines(rows))
    grams = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").encode().lower().split()) else set() for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(grams):
        for b in sorted(grams):
            if a < b and 5 * len(grams[a] & grams[b]) >= 4 * len(grams[a] | grams[b]):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    assert sorted(r.doc_id for r in corpus_pipeline.near_stage(spark, d, sf).collect()) == sorted(i for i in root if root[i] == i)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {i for i, _ in brute_leaks(rows, items)}
    assert sorted(r.doc_id for r in corpus_pipeline.leak_stage(spark, d, sf).collect()) == sorted(i for i, _ in rows if i not in leaked)


def test_quality_stage_keeps_good_and_rejects_toxic_documents(spark):
    """Of some 4,000 labelled documents; with 400 labels (a table ten times smaller) 84 of 100 toxic ones go."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.1"
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).select("doc_id").collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good, toxic = [r for r in labels if r.quality == 1 and r.toxic == 0], [r for r in labels if r.toxic == 1]
    assert np.mean([r.doc_id in kept for r in good]) > 0.95
    assert np.mean([r.doc_id not in kept for r in toxic]) > 0.95


def test_pipeline_packs_what_its_stages_keep(spark):
    """All stages in a row: every document that the stages before leave is packed with all its tokens, and nothing else."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = spark.createDataFrame(stage(spark, d, sf).collect(), d.schema)
    enc = encoding(DEFAULT_RANKS)
    want = {r.doc_id: len(enc.encode_ordinary(r.text or "")) + 1 for r in d.collect()}
    got = collections.Counter()
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r.doc_id] += r.n_tokens
    assert dict(got) == want
