"""Hard negatives, personal data and token alignment against brute force, and their edge cases."""

import collections
import hashlib
import random

import numpy as np
import pytest

from postlens.llm import hard_negatives as H
from postlens.llm import private_data as P
from postlens.llm import token_alignment as T
from postlens.llm.shared import session

# ---- hard negatives


def brute_negatives(rows, every=4, positives=3, negatives=4):
    """By all pairs of whole-number vectors."""
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = set()
    for i, label, v in rows:
        if i % every:
            continue
        near = sorted((-score(v, w), j) for j, k, w in rows if k == label and j != i)[:positives]
        for s, p in near:
            window = [(-score(v, w), j) for j, k, w in rows if k != label and 30 * -s <= 100 * score(v, w) <= 90 * -s]
            for rank, (t, j) in enumerate(sorted(window)[:negatives], 1):
                out.add((i, p, rank, j, -s, -t))
    return out


def vectors(seed, n=160, width=19):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.randint(-40, 60) if rng.random() < 0.8 else 0 for _ in range(width)]
        if i % 5 == 4:
            v = list(rows[i - 3][2])  # copies and ties
        if i % 31 == 7:
            v = [0] * width
        rows.append((i - 20, rng.randint(0, 2), v[: width - i % 3]))
    return rows


@pytest.mark.parametrize("seed,row_block,anchor_block", [(1, 4096, 4096), (2, 13, 7), (3, 40, 4096)])
def test_negatives_equal_brute_force(spark, seed, row_block, anchor_block):
    rows = vectors(seed)
    frame = spark.createDataFrame(rows, "vec_id long, label int, v array<long>")
    got = [tuple(r) for r in H.mine(frame, 4, 3, 4, row_block=row_block, anchor_block=anchor_block).collect()]
    assert len(got) == len(set(got)) and len(got) > 100
    assert set(got) == brute_negatives(rows)


def test_negatives_wide_components(spark):
    """Products beyond what doubles hold are still exact."""
    rows = [(i, i % 2, [(1 << 28) + 3 * i, (1 << 27) - 7 * i * i, i]) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, v array<long>")
    got = {tuple(r) for r in H.mine(frame, 4, 3, 4, low=10, high=150).collect()}
    near = {r[:2] + r[4:5] for r in got}
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    assert near and all(s == score(rows[a][2], rows[p][2]) for a, p, s in near)
    assert all(t == score(rows[a][2], rows[n][2]) for a, _, _, n, _, t in got)


def test_search_loses_no_pair():
    rng = np.random.default_rng(5)
    v, q = rng.integers(-90, 90, (300, 30)), rng.integers(-90, 90, (40, 30))
    index = H.Index(np.arange(300), np.zeros(300), v, q)
    asked, qtails = index.query(q)
    whole = q @ v.T
    for share in (0.7, 0.3, 0.05, -np.inf):
        least = np.where(share == -np.inf, -np.inf, np.abs(share) * qtails[:, 0] * index.tails[:, 0].max())
        i, j, score = index.search(asked, qtails, least)
        assert {*zip(i.tolist(), j.tolist(), score.tolist(), strict=True)} == {(a, b, int(whole[a, b])) for a, b in zip(*np.nonzero(whole >= least[:, None]), strict=True)}


def test_index_omits_covered_dimensions(monkeypatch):
    """A high threshold leaves tails out: fewer products than all."""
    seen = []
    v = np.ones((50, 32), np.int64)
    index = H.Index(np.arange(50), np.zeros(50), v, v[:3])
    asked, qtails = index.query(v[:3])
    real = np.zeros
    monkeypatch.setattr(H.np, "argsort", lambda x, **k: seen.append(-x) or np.arange(len(x)))
    index.search(asked, qtails, np.full(3, 24.0))
    assert real is np.zeros and 0 < seen[0].max() < 4  # of four segments


def test_unusable_vectors_take_no_part(spark):
    rows = [
        (0, 1, [0.5, 0.25]), (4, 1, [0.5, 0.5]), (5, 2, [0.2, 0.2]), (6, None, [9.0, 9.0]), (7, 1, None), (None, 1, [1.0, 1.0]), (8, 2, [float("nan"), 1.0]),
        (9, 2, [None, 1.0]), (10, 2, [float("inf"), 1.0]), (11, 2, [3e38, 1.0]), (5, 2, [0.2, 0.2]), (12, 2, []),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, rank string")
    usable = H.usable(frame)
    assert sorted(r.vec_id for r in usable.collect()) == [0, 4, 5, 5, 12]
    got = sorted(tuple(r) for r in H.mine(usable, 4).collect())
    assert got == [(0, 4, 1, 5, 128 * 128 + 64 * 128, 51 * 128 + 51 * 64), (4, 0, 1, 5, 128 * 128 + 64 * 128, 51 * 256), (12, 5, 1, 0, 0, 0), (12, 5, 2, 4, 0, 0)]
    assert H.mine(H.usable(frame.limit(0))).collect() == []


# ---- personal data


def test_base_spans_are_the_patterns():
    import re

    patterns = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: P.luhn(re.sub("[ -]", "", s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
    ]
    rng = random.Random(3)
    alphabet = "ab1.@-+ (2)%\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    digits = ["".join(rng.choice("0123456789 -.+") for _ in range(40)) for _ in range(2000)]
    fixed = ["a@b.c@d.e", "a@b@c.d", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "4111 1111 1111 1111", "x4111-1111-1111-1111y", "+1 (805) 555-3764", "00000.0.0.0255", "aé@b.c", "+12345678"]
    for text in texts + digits + fixed:
        expected = [(k, *m.span()) for k, (p, good) in enumerate(patterns) for m in re.finditer(p, text) if good(m.group())]
        assert P.base_spans(text) == expected, text


def test_long_runs_cost_once():
    text = "a" * 300_000 + "@" + "1" * 300_000 + "." * 100_000 + "@" * 100_000
    assert P.base_spans(text) == []


PROSE = "when the evening came they walked along the river and spoke of the harvest , the mill and old friends until it grew dark near the village"


def letters(rng):
    words = PROSE.split()
    return " ".join(rng.choice(words) for _ in range(30))


def number(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def card(rng):
    body = "4" + number(rng, 14)
    return next(body + c for c in "0123456789" if P.luhn(body + c))


@pytest.fixture(scope="module")
def trained(spark):
    session(spark)
    rng = random.Random(8)
    make = [
        lambda: f"{rng.choice(PROSE.split())}.{number(rng, 2)}@mail{number(rng, 1)}.example.com", lambda: f"{rng.randint(1, 99)}.{rng.randint(1, 255)}.{rng.randint(1, 255)}.{rng.randint(1, 255)}",
        lambda: card(rng), lambda: f"+1 ({number(rng, 3)}) 555-{number(rng, 4)}", lambda: f"version {number(rng, 1)}.{number(rng, 1)}", lambda: f"in {number(rng, 4)}", lambda: f'token "{number(rng, 4)}ab{number(rng, 5)}c"',
    ]
    rows = [(i, f"{letters(rng)} {make[i % 7]()} {letters(rng)}") for i in range(2100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, P.train(docs, 250, 300)


def test_model_finds_other_forms(trained):
    _, model = trained
    rng = random.Random(77)
    forms = [
        (0, lambda: f"{rng.choice(PROSE.split())}.{number(rng, 2)} (at) mail{number(rng, 1)} (dot) example (dot) com"), (1, lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)).replace(".", "[.]")),
        (2, lambda: "{}.{}.{}.{}".format(*((c := card(rng))[:4], c[4:8], c[8:12], c[12:]))), (3, lambda: f"({number(rng, 3)}) 555-{number(rng, 4)}"),
    ]
    found, clean, total = 0, 0, 0
    for n in range(120):
        kind, form = forms[n % 4]
        span, lead = form(), letters(rng)
        text = f"{lead} {span} {letters(rng)}"
        base = P.base_spans(text)
        added = P.added_spans([text], [base], model)[0]
        total += 1
        found += any(k == kind and lo <= len(lead) + 4 and hi >= len(lead) + len(span) - 3 for k, lo, hi in added + base)
        plain = f"{letters(rng)} version {number(rng, 1)}.{number(rng, 1)} of {number(rng, 4)} {letters(rng)}"
        clean += not P.added_spans([plain], [P.base_spans(plain)], model)[0]
    assert found >= 0.85 * total and clean >= 0.99 * total


def test_spans_over_documents(spark, trained):
    docs, model = trained
    far = "quiet words " * 20_000 + " call +1 (805) 555-3764 or a.b@mail.example.com " + "quiet words " * 20_000
    rows = [(1, None, "x"), (None, "", "y"), (2**60, far, "z"), (2**60, far, "z"), (3, "4111111111111111", "w")]
    extra = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = P.find(extra, model).collect()
    at = far.index("+1"), far.index("a.b@")
    spans = f"email:{at[1]}:{at[1] + 20},phone:{at[0]}:{at[0] + 17}"
    assert len(got) == 5
    assert [r.spans for r in got if r.doc_id == 2**60] == [spans, spans]
    assert all(r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest() for r in got if r.doc_id != 1)
    assert sorted(((r.doc_id or 0), r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == [(0, 0, 0, 0, 0), (1, 0, 0, 0, 0), (3, 0, 0, 1, 0), (2**60, 1, 0, 0, 1), (2**60, 1, 0, 0, 1)]
    assert P.find(extra.limit(0), None).collect() == [] and P.train(extra.limit(0)) is None


def test_reconciled_is_the_heaviest_set():
    rng = random.Random(4)
    for _ in range(200):
        spans = [(rng.randrange(2), lo := rng.randrange(12), lo + rng.randint(1, 5), 0.5, rng.randint(1, 20) / 10) for _ in range(7)]
        got = P.reconciled(spans)
        assert all(a[2] <= b[1] for a, b in zip(got, got[1:], strict=False))
        weight = {(k, lo, hi): max(w for a, b, c, _, w in spans if (a, b, c) == (k, lo, hi)) for k, lo, hi, _, _ in spans}
        best, keys = 0.0, list(weight)
        for mask in range(1 << len(keys)):
            some = sorted((keys[i] for i in range(len(keys)) if mask >> i & 1), key=lambda s: s[1])
            if all(a[2] <= b[1] for a, b in zip(some, some[1:], strict=False)):
                best = max(best, sum(weight[s] for s in some))
        assert abs(sum(weight[s[:3]] for s in got) - best) < 1e-9


def test_gradients_are_the_slope():
    model = P.Tagger(3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, P.CLASSES, (2, 7)), rng.integers(0, P.LABELS, (2, 7))
    _, g = model.gradients(x, y)
    for name in model.p:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        was, sides = model.p[name][at], []
        for step in (1e-2, -1e-2):
            model.p[name][at] = was + step
            sides.append(model.gradients(x, y)[0])
        model.p[name][at] = was
        assert abs((sides[0] - sides[1]) / 2e-2 - g[name][at]) < 2e-3 + 0.01 * abs(g[name][at]), name


# ---- token alignment


def brute_alignment(rows):
    """With the tokenizers' own libraries, one document after the other."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(x for x in range(256) if x not in shown)}
    a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in a_side.get_vocab().items() if t != "<|endoftext|>"}
    b_bytes = lambda i: bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()
    links, out = [], []
    for _, text in rows:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        if not text or not b"".join(a_bytes[i] for i in a) == b"".join(map(b_bytes, b)) == (" " + text).encode():
            links.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(a_bytes[i]) for i in a]), np.cumsum([len(b_bytes(i)) for i in b])
        starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
        pairs = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < ends_b[j] and starts_b[j] < ends_a[i]]
        common, groups, lo = sorted({*ends_a.tolist()} & {*ends_b.tolist()}), [], 0
        for hi in common:
            groups.append(",".join(str(x) for x, e in zip(a, ends_a, strict=True) if lo < e <= hi) + "|" + ",".join(str(x) for x, e in zip(b, ends_b, strict=True) if lo < e <= hi))
            lo = hi
        links.append((a, b, groups, [(a[i], b[j]) for i, j in pairs]))
    count = collections.Counter(p for x in links if x for p in {*x[3]})
    top = collections.Counter()
    for (i, _), n in count.items():
        top[i] = max(top[i], n)
    for (doc, _), x in zip(rows, links, strict=True):
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, groups, found = x
            out.append((doc, len(a), len(b), len(groups), len(found), sum(count[p] == top[p[0]] for p in found), sum(count[p] for p in found), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


AWKWARD = [
    None, "", " ", "a", "  two  blanks ", "tab\there", "line\nline\n\nline", "\n", "Don't we'll it's", "naïve café ﬁn é", "日本語のテキスト 한국어", "emoji 🎉🎉 and   spaces", "under▁score ▁", "<|endoftext|> and <s> </s> <unk>",
    "1234567 3.14 1e10", "x" * 5000, "a b " * 2000, "zero\0byte", "▁", "​hidden", "İstanbul ǅ", "mixed\r\nends\rhere", "a b " * 2000, "…—“quoted”", "word　wide", "\x0bv\x0cf", "퟿", "ab\n cd", " ab",
]


@pytest.mark.parametrize("chunk,shard,fan", [(500_000, 1 << 18, 32), (40, 23, 2)])
def test_alignment_equals_brute_force(spark, monkeypatch, chunk, shard, fan):
    session(spark)
    monkeypatch.setattr(T, "CHUNK", chunk)
    rng = random.Random(6)
    words = [w for t in AWKWARD if t for w in t.split()[:40] if len(w) < 40] + PROSE.split()
    rows = [(i if i % 9 else None, t) for i, t in enumerate(AWKWARD)] + [(100 + i, " ".join(rng.choice(words) for _ in range(25))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, n_a string")
    got = collections.Counter(tuple(r) for r in T.align(docs, shard, fan).collect())
    assert got == collections.Counter(brute_alignment(rows))


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.align(docs).collect() == []


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 30_000):
        keys = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint32))
        hashed = T.PerfectHash.unpack(*T.PerfectHash.of(keys).pack())
        assert sorted(hashed.places(keys).tolist()) == list(range(len(keys)))
    placed = np.empty(len(keys), np.uint32)
    placed[hashed.places(keys)] = keys
    assert (placed[T.verified(hashed, placed, keys[:100])] == keys[:100]).all()
    with pytest.raises(ValueError):
        T.verified(hashed, placed, np.setdiff1d(np.arange(50, dtype=np.uint32), keys))


# ---- inputs that once ended a job


def test_inputs_that_once_ended_a_job(spark):
    from postlens.llm import line_dedup, main_text, near_dedup, url_rules

    session(spark)
    page = "<html><body><article><p>One.</p><![foo[bar]]><p>Two.</p></article><![endif]--><![if x]></body>"
    assert [e.tag for e in main_text.in_order(main_text.parsed(page)) if e.tag == "p"] == ["p", "p"]
    docs = spark.createDataFrame([(1, "a shared line here\nown", "x"), (2, "a shared line here\nother", "y")], "doc_id long, text string, o string")
    done = line_dedup.dedup_lines(docs)
    assert done.columns[:3] == docs.columns and sorted((r.doc_id, r.l_text, r.o) for r in done.collect()) == [(1, "a shared line here\nown", "x"), (2, "other", "y")]
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, {"k": 1}), (1, text, {"k": 1}), (2, text, {"k": 2}), (3, "something else altogether with more words", None)]
    kept = near_dedup.keep_first(spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>"), words=5).collect()
    assert sorted((r.doc_id, r.m) for r in kept) == [(1, {"k": 1}), (3, None)]
    pages = spark.createDataFrame([(1, "https://a.org/x", "p", "q", "r")], "page_id long, url string, u_url string, u_hit string, u_fixed string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged = url_rules.judge(pages, labels).collect()
    assert [(r.u_url, r.u_hit, r.u_fixed, r.u_host) for r in judged] == [("p", "q", "r", "a.org")]


def test_wide_page_ids(spark, tmp_path):
    from postlens.llm import warc

    session(spark)
    rows = [(10**12, "https://a.org/", "x", "u"), (-(2**63), "https://a.org/", "x", "u"), (2**63 - 1, None, None, "u")]
    spark.createDataFrame(rows, "page_id long, url string, html string, extra string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in warc.op1_warc_index(spark, str(tmp_path)).collect()}
    assert set(got) == {10**12, -(2**63), 2**63 - 1} and got[10**12].record_type == "revisit" and got[10**12].refers_to == -(2**63)
