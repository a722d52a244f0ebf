"""The operators on small hand-made rows against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, other columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import arrow_tokens, decontaminate, line_dedup, main_text, near_dedup, packing, quality, suffix_dedup, url_rules, warc
from postlens.llm.components import components
from postlens.llm.shared import session, work_folder
from postlens.llm.tokens import Encoder, encoder

DOCS = "doc_id long, text string, lang string, n long, k long, o long"
SOME = random.Random(3)
WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "Ünder", "ß%%%", "naïve,"]


def prose(n, rnd=SOME):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(300)) for _ in range(n))


def corpus():
    """Edge rows: nulls, empties, white space only, one word, a long text, copies, near copies, a repeated row, a null id."""
    base = prose(160)
    near = " ".join("changed" if i == 40 else w for i, w in enumerate(base.split()))
    shared = "A line that many documents share"
    texts = [None, "", " \n\t ", "word", prose(3000), base, base, near, f"  {shared}\nown {prose(4)}\n{shared.upper()} ", f"{shared}\nother\n\n", "short\nshort", "a\r\n\x0bb  c"]
    rows = [(i, t, "en", 1, 2, 3) for i, t in enumerate(texts)]
    rows += [rows[5], (None, base, None, None, None, None), (None, None, None, None, None, None), (30, prose(30) + "\n" + prose(400), "de", 0, 0, 0)]
    passage = prose(70)
    return rows + [(40 + i, f"{prose(30)} {passage} {prose(20)}", "fr", 0, 0, 0) for i in range(4)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    session(spark)
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    session(spark)
    return spark.createDataFrame([], DOCS)


def collected(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_encoder_equals_library():
    texts = ["a  b", " x", "it's 'll\nDon't", "foo\n\nbar", "don't!x\nY2k 12 3 z", "É́a <|endoftext|> b", "x\ty", "日本 語\n‘a’", "ΑΣ ΣΑΣ\nİ", "a ` b`c", "", "a\x1cb", prose(50)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        codec = Encoder(name)
        assert codec.ids(texts) == codec.encode(texts)
        assert codec.ids(texts) == codec.encode(texts)


def test_tokens_round_trip(spark, docs, rows, none):
    folder = work_folder(spark, "test-tokens")
    got = arrow_tokens.read_tokens(arrow_tokens.write_tokens(docs, folder, length=64), folder, keep_ids=True).collect()
    want = {i: np.append(np.frombuffer(x, dtype="<u4"), 2) for i, x in enumerate(encoder(arrow_tokens.VOCABULARY).ids([r[1] or "" for r in rows]))}
    known = defaultdict(list)
    for i, r in enumerate(rows):
        known[r[0]].append(want[i].tolist())
    assert Counter((r.doc_id, tuple(r.ids), r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (d, tuple(x), len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for d, xs in known.items() for x in xs
    )
    ordered, at = sorted(got, key=lambda r: r.start), 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda d: (d is None, d or 0))
    assert arrow_tokens.read_tokens(arrow_tokens.write_tokens(none, folder), folder).count() == 0


def test_packing(docs, rows, none):
    got = packing.pack(packing.pieces(docs, length=256, keep_ids=True), length=256, group=7).collect()
    texts = Counter()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    codes = encoder(packing.VOCABULARY).ids([r[1] or "" for r in rows])
    for (doc_id, *_), code in zip(rows, codes, strict=True):
        ids = np.frombuffer(code, dtype="<u4").tolist() + [0]
        for k in range(0, len(ids), 256):
            texts[(doc_id, k // 256, k, tuple(ids[k : k + 256]))] += 1
    assert texts == Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in got)
    assert packing.pack(packing.pieces(none)).count() == 0


def test_best_fit_takes_the_tightest():
    rnd = random.Random(1)
    lengths = np.array(sorted((rnd.randrange(1, 101) for _ in range(3000)), reverse=True))
    sequences, offsets = packing.best_fit(lengths, 100)
    rooms = []
    for length, sequence, offset in zip(lengths.tolist(), sequences.tolist(), offsets.tolist(), strict=True):
        fits = [room for room in rooms if room >= length]
        if fits:
            assert 100 - offset == min(fits) and rooms[sequence] == min(fits)
            rooms[sequence] -= length
        else:
            assert sequence == len(rooms) and offset == 0
            rooms.append(100 - length)
    assert sum(rooms) < 0.02 * lengths.sum()


def test_line_dedup(docs, rows, none):
    ends, low = " \t\n\x0b\x0c\r", str.maketrans(line_dedup.UPPER, line_dedup.LOWER)
    key = lambda line: line.strip(ends).translate(low)
    order = lambda d: (1 << 63) - 1 if d is None else d
    holders = defaultdict(set)
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(order(d))
    want = Counter()
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == order(d)]
        want[(d, "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    assert collected(line_dedup.dedup_lines(docs), "doc_id", "l_text", "l_n_lines", "l_n_dropped") == want
    assert sum(k[3] for k in want) >= 3
    assert line_dedup.dedup_lines(none).count() == 0


def removed_by_brute_force(rows, length=400):
    data, places = [(t or "").encode() for _, t, *_ in rows], Counter()
    for d in data:
        places.update(d[p : p + length] for p in range(len(d) - length + 1))
    for (doc_id, *_), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d), dtype=bool)
        for p in range(len(d) - length + 1):
            if places[d[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())
        yield doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()


@pytest.mark.parametrize("most", [1000, 1])
def test_suffix_dedup(spark, docs, rows, none, most):
    base = prose(400)
    more = [(100 + i, base[:900] + prose(60, random.Random(i)) + base[-700:], "", 0, 0, 0) for i in range(12)]
    more += [(200, "ab" * 700, "", 0, 0, 0), (201, base[:100] + "é" * 300 + base[:500] + base[:500], "", 0, 0, 0)]
    every = docs.unionByName(spark.createDataFrame(more, DOCS))
    want = Counter(removed_by_brute_force(rows + more))
    assert collected(suffix_dedup.remove_repeats(every, most=most), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_dedup.remove_repeats(none, most=most).count() == 0


def test_quality_measures(docs, rows, none):
    def measures(text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        count, covered = Counter(windows), set()
        for i, w in enumerate(windows):
            if count[w] > 1:
                covered.update(range(i, i + 8))
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed

    model = quality.Model([0.0] * quality.BUCKETS, None)
    more = docs.union(docs.limit(0))
    got = quality.judge(more, model)
    names = ["q_n_words", "q_word_chars", "q_n_symbols", "q_n_dup_lines", "q_n_repeat_words", "q_base_failed"]
    assert collected(got, "doc_id", *names) == Counter((d, *measures(t)) for d, t, *_ in rows)
    spark = docs.sparkSession
    line = "one two three four five six seven eight nine"
    text = "\n".join([line, line, prose(12), line, "x"])
    assert collected(quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string"), model), *names) == Counter([measures(text)])
    assert quality.judge(none, model).count() == 0


def test_quality_model_parts_held_out_rows(spark):
    session(spark)
    rnd = random.Random(5)
    good = [(i, " ".join(rnd.choice(WORDS) for _ in range(60))) for i in range(300)]
    bad = [(i, " ".join(rnd.choice(WORDS).upper() + "!!" for _ in range(60))) for i in range(300, 400)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.judge(docs, quality.fit(docs, labels)).filter("q_kept").collect()}
    assert len([i for i in range(1, 300, 2) if i in kept]) >= 147 and not [i for i in range(301, 400, 2) if i in kept]
    assert quality.fit(docs, labels.limit(0)).threshold is None
    assert quality.fit(docs.limit(0), labels).threshold is None


def test_quality_rejects_a_few_insults_in_a_long_text(spark):
    session(spark)
    rnd = random.Random(8)
    clean = [(i, prose(400, rnd)) for i in range(160)]
    toxic = [(i, " ".join([prose(200, rnd), rnd.choice(["vermin", "scoundrel"]), prose(200, rnd)])) for i in range(160, 240)]
    docs = spark.createDataFrame(clean + toxic, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i >= 160)) for i in range(0, 240, 2)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.judge(docs, quality.fit(docs, labels)).filter("q_kept").collect()}
    assert len([i for i in range(160) if i in kept]) >= 158 and not [i for i in range(160, 240) if i in kept]


def test_quality_gram_rows_equal_grams(spark):
    texts = [(0, None), (1, ""), (2, "one"), (3, "one one, one"), (4, prose(50)), (4, prose(50)), (5, " \n ,")]
    units = quality.with_units(spark.createDataFrame(texts, "id int, text string"))
    want = units.select("id", F.explode(quality.grams(F.col("q_units"))).alias("q_gram"))
    assert collected(quality.gram_rows(units, "id"), "id", "q_gram") == collected(want, "id", "q_gram")


def test_quality_weights_in_the_row_equal_the_join(spark):
    session(spark)
    rnd = random.Random(6)
    docs = spark.createDataFrame([(i, prose(40, rnd) if i % 3 else prose(40, rnd).upper()) for i in range(240)] + [(500, None), (501, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 240, 2)], "doc_id long, quality int, toxic int")
    row, join = (quality.fit(docs, labels, in_row=n) for n in (quality.IN_ROW_BUCKETS, 0))
    assert row.in_row and not join.in_row and row.threshold == join.threshold is not None
    grams = spark.range(3 * quality.BUCKETS).select(F.col("id").alias("q_gram"), "id")
    assert collected(row.weighed(grams), "id", "q_weight") == collected(join.weighed(grams), "id", "q_weight")
    assert collected(quality.judge(docs, row), "doc_id", "q_kept") == collected(quality.judge(docs, join), "doc_id", "q_kept")


def test_quality_buckets_follow_the_corpus(spark):
    session(spark)
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(2000))) for i in range(1600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    few, many = quality.fit(docs.limit(40), labels), quality.fit(docs, labels)
    assert few.buckets == quality.BUCKETS and many.buckets > quality.BUCKETS
    assert many.weights.count() > 2 * quality.BUCKETS


def jaccard_components(rows, words, percent=80):
    low = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)
    sets = []
    for d, t, *_ in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        n = min(words, len(found))
        sets.append({tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if found else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        r = root(i)
        least[r] = d if least.get(r) is None else min(least[r], d) if d is not None else least[r]
    return Counter((d, len(sets[i]), least[root(i)]) for i, (d, *_) in enumerate(rows))


@pytest.mark.parametrize("words", [2, 5])
def test_near_dedup(spark, docs, rows, none, words):
    base = prose(220).split()
    more = []
    for i in range(60):  # a group around one text whose copies differ from each other by more than from it
        copy = list(base)
        for j in random.Random(i).sample(range(220), 12 if words == 2 else 4):
            copy[j] = f"edit{i}x{j}"
        more.append((300 + i, " ".join(copy), "", 0, 0, 0))
    more.append((299, " ".join(base), "", 0, 0, 0))
    every = docs.unionByName(spark.createDataFrame(more, DOCS))
    assert collected(near_dedup.near_groups(every, words), "doc_id", "n_shingles", "component_id") == jaccard_components(rows + more, words)
    assert near_dedup.near_groups(none, words).count() == 0
    kept = near_dedup.keep_first(every, words)
    assert kept.columns == every.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 299 in ids and not ids & set(range(300, 360)) and {0, 1, 2, 3, 4, 5} <= ids and 6 not in ids


@pytest.mark.parametrize("words", [2, 5])
def test_near_dedup_keeps_one_row_of_each_group(spark, words):
    session(spark)
    rnd = random.Random(12)
    one, two, three = (prose(200, rnd) for _ in range(3))
    edit = lambda t, k: " ".join(f"edit{k}" if i == k else w for i, w in enumerate(t.split()))
    rows = [(1, one), (1, one), (1, edit(one, 5)), (2, one), (None, one), (None, two), (None, two), (None, edit(two, 9)), (3, three), (4, ""), (4, None), (5, ""), (None, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", i, 0, 0) for i, (d, t) in enumerate(rows)], DOCS)
    kept = near_dedup.keep_first(docs, words).collect()
    named = {one: "one", edit(one, 5): "one", two: "two", edit(two, 9): "two", three: "three"}
    assert Counter((r.doc_id, named.get(r.text, "")) for r in kept) == Counter(
        {(1, "one"): 1, (None, "two"): 1, (3, "three"): 1, (4, ""): 1, (5, ""): 1, (None, ""): 2}
    )


def test_odd_sketch_tells_high_similarity():
    rnd = np.random.default_rng(1)
    a = np.unique(rnd.integers(0, 1 << 64, 1000, dtype=np.uint64))
    for common, near in ((950, True), (889, True), (300, False)):
        b = np.unique(np.append(a[:common], rnd.integers(0, 1 << 64, 1000 - common, dtype=np.uint64)))
        x, y = (np.frombuffer(near_dedup.odd_sketch(near_dedup.samples(s)), dtype=np.uint64) for s in (a, b))
        assert (np.bitwise_count(x ^ y).sum() <= near_dedup.FARTHEST) == near


def test_components(spark):
    session(spark)
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    up = {}
    for a, b in edges:
        for x in (a, b):
            up.setdefault(x, x)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    want = Counter((x, root(x)) for x in up if any(x in e and e[0] != e[1] for e in edges))
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert collected(got, "node", "component") == want


def edit_distance_within(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination(spark, docs, none):
    session(spark)
    rnd = random.Random(9)
    items = [(i, prose(30, rnd)) for i in range(6)] + [(6, "tiny item"), (7, ""), (8, None), (None, prose(9, rnd)), (0, prose(25, rnd))]

    def damaged(text, edits):
        chars = list(text)
        for _ in range(edits):
            p = rnd.randrange(len(chars))
            rnd.choice([lambda: chars.insert(p, "q"), lambda: chars.pop(p), lambda: chars.__setitem__(p, "z")])()
        return "".join(chars)

    texts = [prose(40, rnd)] + [f"{prose(20, rnd)} {damaged(items[i % 6][1], 2 * i)}\n {prose(15, rnd)}" for i in range(14)]
    rows = [(i, t.upper() if i % 2 else t.replace(" ", "  ")) for i, t in enumerate(texts)] + [(50, None), (51, ""), (52, "tiny item"), (1, texts[2])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, t in rows:
        for n, item in items:
            plain = decontaminate.plain(item or "")
            if n is not None and t and len(plain) >= decontaminate.MIN_CHARS:
                distance = edit_distance_within(plain, decontaminate.plain(t))
                if distance <= int(decontaminate.ERRORS * len(plain)):
                    want[(d, n)] = min(distance, want.get((d, n), distance))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(decontaminate.leaks(frame, benchmark), "doc_id", "item_id", "distance") == Counter((*k, v) for k, v in want.items())
    assert len(want) > 8
    clean = decontaminate.keep_clean(docs.unionByName(frame, allowMissingColumns=True), benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.filter("doc_id is not null").collect()} >= {0, 50, 51, 52}
    assert decontaminate.leaks(none, benchmark).count() == 0 and decontaminate.leaks(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.keep_clean(docs, benchmark.limit(0)).count() == docs.count()


def test_keep_clean_uses_items_without_an_id(spark):
    session(spark)
    rnd = random.Random(10)
    item = prose(12, rnd)
    frame = spark.createDataFrame([(1, f"{prose(9, rnd)} {item}"), (2, prose(30, rnd))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, item)], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.keep_clean(frame, benchmark).collect()] == [2]
    assert decontaminate.leaks(frame, benchmark).count() == 0


PAGES = "page_id long, url string, html string, host string, text string"


def test_warc_round_trip(spark):
    session(spark)
    rows = [(3, "http://www.a.org/x?q=1#f", "<p>é</p>"), (1, "http://a.org/x", "<p>é</p>"), (2, None, None), (4, "no scheme\r\n%", ""), (5, "https://B.org:81", "y" * 300_000)]
    rows += [(1, "http://a.org/x", "<p>é</p>"), (None, "http://a.org/x", "<p>é</p>"), (None, "http://c.org", "alone"), (9, "http://a.org/x", "HTTP/1.1\r\n\r\nodd\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "h", "t") for r in rows], PAGES)
    folder = work_folder(spark, "test-warc")
    index = warc.merge_runs(warc.write_archives(pages, folder))
    entries = index.collect()
    keys = [(e.url_key, e.captured_at, e.page_id is None, e.page_id or 0) for e in entries]
    assert keys == sorted(keys)
    want = Counter()
    for page, url, html in rows:
        data = (html or "").encode()
        first = min((r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None), default=None)
        again = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[(page, len(data), digest, "revisit" if again else "response", first if again else None, url or "")] += 1
    got = warc.read_archives(index, folder)
    assert collected(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url") == want
    assert warc.merge_runs(warc.write_archives(pages.limit(0), folder)).count() == 0


def test_loser_tree():
    rnd = random.Random(4)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((rnd.randrange(50), i) for _ in range(rnd.randrange(20))) for i in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


HTML = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="page">
<header id="top">Site</header><nav><ul><li>Home<li>More</ul></nav><div class="cookie-notice">Cookies</div>
<article><header><h1>Head &amp; line</h1></header><p>One <b>bold</b><br>line &#233;<p>Two<div class="ad">Buy</div><form>Mail <input></form>
<ul><li>a<li>b</ul><table><tr><td>x<td>y</table><pre>p  q</pre><section class="comments"><p>First!</p></section><div>Subscribe to us</div></article>
<aside>Side</aside><footer>Foot</footer></body></html>"""


def test_main_text(spark):
    session(spark)
    other = "<body><div>Plain &lt;b&gt; text</div><p>and <i>more</i><div>Subscribe to us</div>"
    rows = [(i, f"http://h.org/{i}", HTML.replace("Two", f"Two {i}")) for i in range(6)]
    rows += [(10, None, None), (11, "http://x.org", ""), (12, "http://x.org", other), (12, "http://x.org", other), (None, "http://y.org", "<article>" + "<div>" * 3000 + "deep"), (14, "z", "a < b & c <p")]
    got = main_text.extract(spark.createDataFrame([(*r, "h", "t") for r in rows], PAGES))
    article = "Head & line\nOne bold line é\nTwo {}\na\nb\nx\ny\np q"
    want = Counter((i, article.format(i)) for i in range(6))  # lists, tables and the repeated box are on every page of the host
    found = collected(got, "page_id", "text")
    lines = {i: t.split("\n") for (i, t) in found if i is not None}
    for i in range(6):
        assert lines[i] == [f"Two {i}"], lines[i]  # all else of the article is on every page, so it is a template
    assert found[(10, "")] == found[(11, "")] == 1 and found[(12, "Plain <b> text\nand more\nSubscribe to us")] == 2 and found[(None, "deep")] == 1
    assert len(want) == 6 and all(r.n_chars == len(r.text) for r in got.collect())
    alone = main_text.main_text(HTML, set())
    assert alone == "Head & line\nOne bold line é\nTwo\na\nb\nx\ny\np q\nSubscribe to us"


def test_main_text_keeps_articles_that_are_copied(spark):
    session(spark)
    page = "<body><div>Menu of all</div><article><h1>Same head</h1><p>Same text</p></article></body>"
    plain = "<body><div>Only text</div><p>and more</p></body>"
    rows = [(i, f"http://copies.org/?utm_source={i}", page) for i in range(8)] + [(20 + i, f"http://plain.org/{i}", plain) for i in range(8)]
    rows += [(40 + i, f"http://different.org/{i}", f"<body><div>Menu</div><p>Own {i}</p></body>") for i in range(8)]
    got = collected(main_text.extract(spark.createDataFrame([(*r, "h", "t") for r in rows], PAGES)), "page_id", "text")
    want = {i: "Same head\nSame text" for i in range(8)} | {20 + i: "Only text\nand more" for i in range(8)} | {40 + i: f"Own {i}" for i in range(8)}
    assert got == Counter(want.items())


def test_url_rules(spark):
    session(spark)
    urls = ["http://a.example.org/es/1", "http://example.org/en/12?x", "https://Example.ORG/en/2", "http://x.com/fr/a", "http://x.com/de/a#b", "http://com/de/", None, "nothing", "http://org", "http://y.net/a?b://c", "x://y.net//z"]
    known = {0: ("example.org/es/", "block"), 1: ("example.org/en/1", "block"), 2: ("org/", "allow"), 3: ("com/fr/", "allow"), 4: ("com/de/", "block"), 5: ("com/de/", "block")}
    rows = [(i, u) for i, u in enumerate(urls)] + [(100 + i, f"http://bad.net/pills{i % 3}/{i}") for i in range(20)] + [(200 + i, f"http://good.net/news/{i}") for i in range(30)]
    rows += [(300, "http://other.net/bad/news"), (301, "http://bad.net/none"), (None, "http://bad.net/x")]
    pages = spark.createDataFrame([(*r, "", "h", "t") for r in rows], "page_id long, url string, html string, host string, verdict string")
    labels = spark.createDataFrame([(100 + i, 0, 0) for i in range(20)] + [(200 + i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    judged = url_rules.judge(pages, labels).collect()
    got = {r.page_id: r for r in judged}
    assert len(judged) == len(rows)
    for i, (rule, verdict) in known.items():
        assert (got[i].u_rule, got[i].u_verdict) == (rule, verdict)
    assert (got[6].u_host, got[6].u_path, got[7].u_host) == ("", "", "") and (got[8].u_host, got[8].u_path, got[8].u_rule) == ("org", "", None)
    assert (got[9].u_host, got[9].u_path, got[10].u_path) == ("y.net", "/a", "//z")
    assert all(got[100 + i].u_verdict == "block" for i in range(20)) and all(got[200 + i].u_verdict == "allow" for i in range(20))
    assert got[301].u_verdict == "block" and got[None].u_verdict == "block"
    assert url_rules.judge(pages, labels.limit(0)).filter("u_verdict = 'block'").count() == 4
    assert url_rules.judge(pages.limit(0), labels).count() == 0
