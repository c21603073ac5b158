"""The algorithms on their own, against brute force."""

import gzip
import io
import random
import zlib

import numpy as np
import pytest

from veilsift.llm import html_extract, langid, packing, quality, simhash, token_count, toxicity, vptree, warc

P = pytest.importorskip("public_tokenizers")


def test_token_counts_equal_the_library():
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp, counter = sentencepiece.SentencePieceProcessor(model_file=path), token_count.PieceCounter(path, memo_words=500)
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "é", "日", "😀", "\t", "▁", "=", "-", "0", "\x00", "<s>", "ing"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", " " * 500, "ab" * 20_000, "".join(rng.choice("abcdef") for _ in range(5000)), " " * 33 + "x"]
    assert counter.counts(texts) == [len(sp.encode(t)) for t in texts]
    assert counter.counts([None]) == [0]


def test_document_ids_equal_the_library():
    t = packing.DocTokenizer(P.path("byte_bpe_50k.json"))
    assert t.fast is not None
    rng = random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "the", "é", "日", "😀", "\t", "<|endoftext|>", " ", "'s", "　", "\x1c", "\x85", "9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert t(texts) == [np.array(t.slow.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert packing.DocTokenizer(P.path("word_bpe_49k.json")).fast is None


@pytest.mark.parametrize("space", [" ", "\t", "\u00a0"])
def test_document_ids_of_very_long_white_space(space):
    t = packing.DocTokenizer(P.path("byte_bpe_50k.json"))
    n = 2_000_000 if space == " " else 1_100_000
    for text in (space * n, "x" + space * n + "y", "a b" + space * n):
        assert t([text]) == [np.array(t.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


def test_page_records_are_whole_warc():
    date = "2026-01-02T03:04:05Z"
    a = warc.page_record(7, None, "response", "ab" * 32, 3, None, b"<p>", date)
    b = warc.page_record("7/\r\n8", "http://h/\r\nx", "revisit", "ab" * 32, 3, 7, b"", date)
    for data in (a, b):
        head, block = warc.parse(data)
        assert {"warc-record-id", "warc-date", "warc-type", "content-length"} <= set(head) and head["warc-date"] == date
        assert block.startswith(b"HTTP/1.1 200 OK\r\n") and head["content-type"] == "application/http; msgtype=response"
    first, again = warc.parse(a), warc.parse(b)
    assert again[0]["warc-refers-to"] == first[0]["warc-record-id"] and again[0]["warc-profile"] == warc.REVISIT
    assert warc.page_of(*first) == ("7", None, "response", "ab" * 32, 3, None, b"<p>")
    assert warc.page_of(*again) == ("7/\r\n8", "http://h/ x", "revisit", "ab" * 32, 3, "7", b"")


def test_packer_keeps_every_id_once_and_fills_windows():
    rng = random.Random(3)
    packer, rests = packing.Packer((64, 32, 16)), []
    for doc in range(200):
        n = rng.randint(1, 63)
        ids = np.arange(n, dtype="<u4").tobytes()
        rests.append((doc, 0, n, ids, n))
        packer.add(rests[-1])
    windows = packer.flush() + packer.flush(last=True)
    seen = {}
    for _, pieces in windows:
        size = sum(p[2] for p in pieces)
        assert size & (size - 1) == 0 and size <= 64
        for doc, start, n, ids, total in pieces:
            assert np.frombuffer(ids, "<u4").tolist() == list(range(start, start + n))
            seen.setdefault(doc, []).extend(range(start, start + n))
    assert {d: sorted(x) for d, x in seen.items()} == {d: list(range(n)) for d, _, n, _, _ in rests}


def brute_links(fps, bits=4):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= bits:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_fingerprint_by_bits():
    import xxhash

    text = "The quick  brown\nfox jumps over THE lazy dog and naps"
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(len(w) - 3)]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("Two Words") == xxhash.xxh64_intdigest("two words", 42)
    assert simhash.fingerprint("") == simhash.fingerprint(None) == simhash.fingerprint(" \n\t") == 0
    assert simhash.fingerprint("a b") == xxhash.xxh64_intdigest("a b", 42)


def test_between_blocks_finds_all_connections():
    rng = random.Random(4)
    base = rng.getrandbits(64)
    near = [base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(40)]
    a, b = np.array(near[:20], np.uint64), np.array(near[20:], np.uint64)
    for choice in range(len(simhash.CHOICES)):
        left, right = simhash._between(a, b, choice, 4)
        assert all(bin(int(x) ^ int(y)).count("1") <= 4 for x, y in zip(left, right, strict=True))


def test_count_filter_rejects_what_verification_would_and_no_link():
    rng = random.Random(9)
    base = rng.getrandbits(64)
    met = passed = links = 0
    for _ in range(4000):
        other = base
        for bit in rng.sample(range(64), rng.randint(0, 7)):
            other ^= 1 << bit
        a, b = np.array([base], np.uint64), np.array([other], np.uint64)
        tally = sum(base >> 8 * p & 255 == other >> 8 * p & 255 for p in range(8))
        assert simhash.TALLY[simhash.shared_bytes(a, b)[0]] == tally
        first = int(simhash.FIRST[simhash.shared_bytes(a, b)[0]])
        met += first >= 0
        kept = sum(len(simhash.retained(a, b, c, 4)) for c in range(len(simhash.CHOICES)))
        assert kept == (tally >= 4)  # a pair counts under one choice
        passed += kept
        near = bin(base ^ other).count("1") <= 4
        found = sum(int(simhash._linked(a, b, c, 4)[0]) for c in range(len(simhash.CHOICES)))
        assert found == near and (not near or kept)
        links += near
    assert links < passed < met  # the filter works before verification does


def test_repeated_words_by_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        w = [rng.choice([b"a", b"b"]) for _ in range(rng.randint(0, 30))]
        win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        want = {j for i, x in enumerate(win) if win.count(x) > 1 for j in range(i, i + 5)}
        assert quality.repeated_words(w) == len(want)


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(6)
    model = (["aa", "bb", "cc"], np.zeros((1 << langid.BITS, 3), np.float32), np.ones((3, len(langid.NAMES)), bool))
    lab = langid.Labeller(model, switch=2.0)
    for _ in range(100):
        s = rng.normal(size=(6, 3)) * 2
        path = lab.path(s)
        value = lambda p, s=s: sum(s[i, k] for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))
        assert value(path) == pytest.approx(max(map(value, itertools.product(range(3), repeat=6))))
    for _ in range(100):  # long ones, whose stretches lie apart
        s = np.where(rng.random((400, 1)) < 0.9, [[0.0, -1.0, -2.0]], rng.normal(size=(400, 3)) * 3)
        at = rng.integers(0, 390)
        s[at : at + 8] = [-3.0, -1.0, 0.0]
        value = lambda p, s=s: s[np.arange(400), p].sum() - 2.0 * (np.diff(p) != 0).sum()
        assert value(lab.path(s)) == pytest.approx(value(lab._stretch(s, None, None)))


def test_scripts_narrow_the_candidates():
    uses = np.zeros((2, len(langid.NAMES)), bool)
    uses[0, langid.NAMES.index("latin")] = uses[1, langid.NAMES.index("cyrillic")] = True
    lab = langid.Labeller((["aa", "bb"], np.zeros((1 << langid.BITS, 2), np.float32), uses))
    assert [lab.labelled([t])[0][0] for t in ("word", "слово", "日本 слово", "123 ...", None, "日本")] == ["aa", "bb", "bb", "und", "und", "aa"]
    langs, share, spans = lab.labelled(["one two three four five 7 слово и ещё слово здесь"])
    assert [(x["first"], x["end"], x["lang"]) for x in spans[0]] == [(0, 6, "aa"), (6, 11, "bb")] and langs == ["aa"] and share == [0.5]


def test_exact_tree_search_equals_brute_force_and_relaxed_recall_is_high():
    rng = np.random.default_rng(7)
    v = rng.normal(size=(600, 8))
    v[100:400] = v[0]  # many copies
    ids = rng.permutation(600)
    tree = vptree.VPTree(ids, v)
    q = rng.normal(size=(20, 8))
    best, score = tree.search(q, 5, factor=1.0)
    want = np.sort(np.unique((q @ tree.points.T).round(9), axis=1), axis=1)[:, ::-1][:, :5]
    assert np.allclose(score, np.sort(q @ tree.points.T, axis=1)[:, ::-1][:, :5]) and want.shape[1] == 5
    _, relaxed = tree.search(q, 5)
    assert (relaxed >= score[:, -1:] - 1e-9).mean() >= 0.9
    # a limit from elsewhere keeps nothing better out
    _, limited = tree.search(q, 5, 1.0, vptree.distance(q, score[:, 1:2], tree.top)[:, 0])
    assert np.allclose(limited[:, :2], score[:, :2])


def test_triangle_bounds_pass_over_leaves_and_shards():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(16, 8)) * 40
    v = centres[rng.integers(16, size=4000)] + rng.normal(size=(4000, 8))
    tree, top = vptree.VPTree(np.arange(4000), v), (v**2).sum(axis=1).max()
    q = v[:50]
    _, score = tree.search(q, 5, 1.0)
    assert np.allclose(score, np.sort(q @ v.T, axis=1)[:, ::-1][:, :5])
    assert tree.visited < 0.7 * len(q) * len(tree.leaves)
    balls = vptree.Balls.fit(v[::4], top, 8)
    home, bound = balls.shard(v), balls.bounds(q)
    assert len(np.unique(home)) == 8
    d = vptree.distance(q, q @ v.T, top)
    for s in range(8):  # a bound is never above a distance
        assert (bound[:, s] <= d[:, home == s].min(axis=1) + 1e-6).all()
    open_ = bound <= vptree.distance(q, score[:, -1:], top)
    assert open_.mean() < 0.9


def test_gzip_stream_to_members():
    a = warc.record({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:1>"}, b"x" * 5000)
    b = warc.record({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:2>"}, b"\r\n\r\nWARC/1.1\r\n\r\n")
    for packed in (gzip.compress(a + b), gzip.compress(a) + gzip.compress(b)):
        assert list(warc.records_of(warc.inflate(io.BytesIO(packed)))) == [a, b]
    assert zlib.decompress(warc.deflate(a), 31) == a
    assert warc.parse(b)[1] == b"\r\n\r\nWARC/1.1\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.records_of(iter([a[:-3]])))


def test_extract_takes_the_article_and_leaves_frames():
    score = html_extract.weights(*html_extract.learn([]))
    page = (
        "<html><head><title>T words here</title></head><body><nav><a href=/>Home page</a></nav><div class='ad'>Buy this now please</div>"
        "<article><h1>Head&amp;line</h1><p>One  two\n three<br>four <b>fi</b>ve<form>Your name <input></form><p>And &eacute; so on it goes"
        "<div class=comments><p>I do not like it at all</p></div></article><footer>&copy; me and all the others</footer></body></html>"
    )
    assert html_extract.extract(page, score) == "Head&line\nOne two three four five\nAnd é so on it goes"
    assert html_extract.extract(None, score) == html_extract.extract("", score) == html_extract.extract("<script>a b c</script>", score) == ""
    assert html_extract.extract("just some text <p", score) == "just some text"
    page = (
        "<body><header><h1>Site</h1></header><div class='with-sidebar'><div id=content><h2>Head</h2><p>Words and words and words.</p>"
        "<div class=cookie-notice>We use cookies</div><p>Even more words.</p></div></div><div id=comments><p>Reader text one two</p></div><footer>c</footer>"
    )
    assert html_extract.extract(page, score) == "Head\nWords and words and words.\nEven more words."
    page = (
        "<div id=wrap class=sidebar><article><div class=entry-header><h1>Title of it</h1></div><p>Text goes on and on.</p>"
        "<ol class=comment-list><li><article class=comment-body><p>A reader says something long here.</p></article></ol></article></div>"
    )
    assert html_extract.extract(page, score) == "Title of it\nText goes on and on."


def test_best_run_equals_all_runs():
    rng = random.Random(10)
    for _ in range(300):
        g = [rng.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(rng.randint(0, 25))]
        most = max((sum(g[i:j]) for i in range(len(g)) for j in range(i + 1, len(g) + 1)), default=0)
        a, b = html_extract.best_run(g)
        assert (sum(g[a:b]) == most and b > a) if most > 0 else (a, b) == (0, 0)


def _pages(n, seed):
    """Pages with a marked article, and the text of each."""
    rng = random.Random(seed)
    words = lambda k: " ".join("".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(k))
    out = []
    for _ in range(n):
        blocks = [words(rng.randint(3, 8))] + [words(rng.randint(2, 60)) for _ in range(rng.randint(2, 6))]
        links = "".join(f"<li><a href=/>{words(1)}</a></li>" for _ in range(6))
        head, rest = blocks[0], "".join(f"<p>{x}</p>" for x in blocks[1:])
        out.append((f"<html><body><nav><ul>{links}</ul></nav><div class='ad'>{words(3)}</div><article><h1>{head}</h1>{rest}</article><footer>{words(5)}</footer></body></html>", "\n".join(blocks)))
    return out


def test_learnt_weights_find_articles_that_nothing_marks():
    learnt = html_extract.weights(*html_extract.learn(p for p, _ in _pages(60, 1)))
    pages, priors = _pages(40, 2), dict(html_extract.PRIOR)
    assert all(html_extract.extract(p, w) == t for p, t in pages for w in (learnt, priors))
    renamed = [(p.replace("article", "div"), t) for p, t in pages]
    assert all(html_extract.extract(p, learnt) == t for p, t in renamed)
    bare = [(p.replace("<nav", "<div").replace("</nav", "</div").replace("footer", "div").replace(" class='ad'", ""), t) for p, t in renamed]
    assert all(html_extract.extract(p, learnt) == t for p, t in bare)
    assert not all(html_extract.extract(p, priors) == t for p, t in bare)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>before</p><svg/><p>after</p></article>", "before\nafter"),
        ("<article><p>before</p><svg><text>no</text><svg/></svg><math/><p>after</p></article>", "before\nafter"),
        ('<p title="a hidden gem">text</p>', "text"),
        ('<p data-x="display:none">text</p><p hidden>no</p><p style="display: none">no</p>', "text"),
        ('<article><p>one</p><div class="related-work"><p>two</p></div><div class="legal-news">three</div></article>', "one\ntwo\nthree"),
        ('<div class="related-work"><p>some text in here</p></div>', "some text in here"),
        ('<article><p>one</p><div class="related-posts">no</div><div class="newsletterSignup">no</div><div id="share-links">no</div></article>', "one"),
        ("<article><p>one</p><noscript>no</noscript><template><p>no</p></template><select><option>no</select><p>two</p></article>", "one\ntwo"),
        ('<article><p>a &lt;b&gt; &#233;&nbsp;c</p><div class="comment-list"><p>no</p></div></article>', "a <b> é c"),
    ],
)
def test_pages_come_out_whole(page, text):
    for score in (dict(html_extract.PRIOR), html_extract.weights(*html_extract.learn(p for p, _ in _pages(30, 3)))):
        assert html_extract.extract(page, score) == text


def test_framing_elements_cost_little_all_told():
    score = dict(html_extract.PRIOR)
    page = "<p>" + "word " * 12 + "</p><form>" + "<div><p>no no no no</p></div>" * 50 + "</form><p>" + "more " * 12 + "</p>"
    found = html_extract.tokens(page)
    gain = html_extract.gains(found, score)
    assert sum(g for g, x in zip(gain, found, strict=True) if x[2] == "frame") == pytest.approx(-html_extract.FRAME_MOST)
    assert html_extract.extract(page, score) == ("word " * 12).strip() + "\n" + ("more " * 12).strip()


def test_ftrl_learns_a_word():
    h = toxicity.Hasher()
    rng = random.Random(8)
    rows = []
    for _ in range(400):
        y = rng.random() < 0.3
        words = [rng.choice("abcdefghij") * 3 for _ in range(20)] + ["nasty"] * y
        rng.shuffle(words)
        rows.append((np.unique(h(" ".join(words))), int(y)))
    at, w, bias = toxicity.train_ftrl(rows, toxicity.BITS)
    table = np.zeros(1 << toxicity.BITS)
    table[at] = w
    said = [bias + table[i].sum() > 0 for i, _ in rows]
    assert sum(s == bool(y) for s, (_, y) in zip(said, rows, strict=True)) > 390
    assert len(h("")) == len(h(None)) == 0


def plain_ftrl(examples, places, alpha, beta, l1, l2, epochs):
    """One coordinate at a time, as the published update has it; the intercept by the same rate without L1 or L2."""
    import math

    z, n, bias, bias_n = [0.0] * places, [0.0] * places, 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for idx, y in examples:
            w = {i: weight(i) for i in idx}
            p = 1 / (1 + math.exp(-max(-35, min(35, bias + sum(w.values())))))
            g = p - y
            for i in idx:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
            bias_n += g * g
            bias -= alpha * g / (beta + math.sqrt(bias_n))
    return [weight(i) for i in range(places)], bias


def test_ftrl_equals_the_scalar_rule():
    rng = random.Random(11)
    rows = [(sorted(rng.sample(range(64), rng.randint(0, 12))), int(rng.random() < 0.4)) for _ in range(300)]
    want, bias = plain_ftrl(rows, 64, 0.7, 1.0, 0.5, 0.1, 3)
    at, w, got = toxicity.train_ftrl([(np.array(i, np.int64), y) for i, y in rows], 6, alpha=0.7, beta=1.0, l1=0.5, l2=0.1, epochs=3)
    table = np.zeros(64)
    table[at] = w
    assert np.allclose(table, want) and got == pytest.approx(bias)
    assert 0 < len(at) < 64  # L1 leaves some at zero


def test_features_are_words_neighbours_and_skips():
    h = toxicity.Hasher(bits=30)
    one = lambda *w: set(h(" ".join(w)).tolist())
    a, b, c = (one(x) for x in ("aa", "bb", "cc"))
    abc = one("aa", "bb", "cc")
    assert a | b | c < abc and len(abc) == 6  # three words, two pairs, one pair with a gap
    assert one("aa", "bb") < abc and one("bb", "cc") < abc and len(one("aa", "xx", "cc") & abc) == 3
    assert one("AA!") == a
    long = "word " * 400_000 + "nasty"
    assert len(h(long)) == 3 * 400_001 - 3 and set(h("nasty").tolist()) < set(h(long).tolist())
