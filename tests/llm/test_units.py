"""Parts that need no session: packing, tokens, trees, text of pages, edit similarity, apportionment by brute force."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillon.llm import html_text, licenses, line_dedup, near_dup, quality_model, quality_rules, token_files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=70), min_size=1, max_size=6))
def test_simple8b_round_trip(lists):
    arrays = [np.array(x, np.uint64) for x in lists]
    counts = [len(a) for a in arrays]
    blocks = token_files.encode_blocks(np.concatenate(arrays), np.cumsum(counts))
    assert (token_files.decode_blocks(blocks, counts) == np.concatenate(arrays)).all()
    for b, a in zip(blocks, arrays, strict=True):
        assert len(b) % 8 == 0 and (token_files.decode(b, len(a)) == a).all()


def test_simple8b_packs_small_ids_tightly():
    assert len(token_files.encode(np.ones(60, np.uint64))) == 8 and len(token_files.encode(np.full(3, 50000, np.uint64))) == 8


def test_pieces_give_what_the_library_gives_for_whole_texts():
    P = pytest.importorskip("public_tokenizers")
    encoder = token_files.Encoder(P.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    parts = [*"ab Éß\n\t'’.,!#|&1²٣ \xa0x-_\x1c<>", "  ", "'s", "'ll", "<|endoftext|>", "don't", "...", "\r\n", "日本"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder(texts) == want


def test_pieces_of_bytes_are_those_of_the_expression():
    letters, marks = "A-Za-zÀ-ÖØ-öø-ÿ", re.escape("!#$%&*+,-./:;=?@^_|~()")
    piece = re.compile(rf" ?[{letters}]+(?=[{marks}]*(?:[ \n]|$))|[{marks}]+(?=[ \n]|$)| ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")
    rng = random.Random(4)
    texts = ["".join(rng.choices(" \n ab.,'é×÷ÿ1(日ė", k=rng.randint(0, 12))) for _ in range(5000)]
    data, offsets = "".join(texts).encode(), np.cumsum([0, *(len(t.encode()) for t in texts)])
    start = token_files.piece_starts(np.frombuffer(data, np.uint8), offsets)
    got = [data[a:b].decode() for a, b in zip(start, [*start[1:], len(data)], strict=True)]
    assert got == [p for t in texts for p in piece.findall(t)]


def test_each_word_is_encoded_once_and_words_of_a_chunk_in_one_call():
    P = pytest.importorskip("public_tokenizers")
    library = token_files.Encoder(P.path("byte_bpe_50k.json")).tokenizer
    encoder, calls = token_files.Encoder(P.path("byte_bpe_50k.json")), []
    encoder.known = token_files._Known(P.path("byte_bpe_50k.json"))

    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.append(texts)
            return library.encode_batch_fast(texts, **options)

    encoder.known.tokenizer = Counting()
    texts = [f"word{i % 7} sesquipedalian, of {i % 5}." for i in range(100)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for part in (slice(0, 50), slice(50, 100)):
        ids, ends = encoder.encode(pa.array([None, *texts, ""])[1:-1][part])
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == want[part]
    assert len(calls) == 1 and len(calls[0]) == 1 and calls[0][0].count("sesqui") == 1
    ids, ends = encoder.encode(pa.array([None, "", "a", None]))
    assert ends.tolist() == [0, 0, 1, 1] and len(ids) == 1


def test_main_text():
    page = """<html><head><title>T</title><script>var a="</p>";</script></head><body class="home"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies.</div>
    <nav><ul><li><a href=x>Home</a></ul></nav><div><div class="content"><h2>Title &amp; more</h2><p>First <b>para</b> with <a href="u">a link</a> and&nbsp;enough   text
    to count.<p>Second</div><div class="sidebar">Side</div></div><section id="comments"><p>Nice post, I liked it very much indeed!</p></section><form>Sign up</form><footer>f</footer></body>"""
    assert html_text.main_text(page) == "Title & more\nFirst para with a link and enough text to count.\nSecond"
    assert [html_text.main_text(x) for x in (None, "", "<", "<p>a<p>b", "plain <b>text</b>", "<div>" * 20000 + "deep")] == ["", "", "<", "a\nb", "plain text", "deep"]


ARTICLE = "<h2>Title</h2><p>" + "Some words of the article that matter. " * 8 + "</p><p>" + "More words stand in the second paragraph. " * 6 + "</p>"
LIST = "<ul>" + "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(20)) + "</ul>"


@pytest.mark.parametrize(
    "page",
    [
        '<div class="page no-sidebar">{}</div>', '<div class="has-header-image">{}</div>', '<body><div id="alert-2">{}</div></body>', '<div data-id="menu" data-role="navigation" data-class="footer">{}</div>',
        "<body><form>{}</form></body>", "<body>" + LIST + "<div>{}</div>" + LIST + "</body>", "<body><div>{}</div><div><h3>Comments</h3><p>I liked it a lot</p><p>Me too</p></div></body>",
        "<body><div>{}<h3>3 Comments</h3><p>I liked it a lot</p></div></body>", "<body><div>{}</div><div>Copyright 2020 Foo inc</div></body>", '<body><div>{}</div><div class="comments">' + "<p>text of a reader, which is long</p>" * 30 + "</div></body>",
        "<body><article>{}</article><aside>see also</aside></body>", '<body><div class="cookie-notice">We use cookies</div><main>{}</main></body>',
    ],
)
def test_the_article_stays_and_the_rest_goes(page):
    want = html_text.main_text(f"<body><div>{ARTICLE}</div></body>")
    assert want.count("\n") == 2 and html_text.main_text(page.replace("{}", ARTICLE)) == want


def test_paragraphs_that_only_look_marked_stay():
    for p in ('<p title="hidden">kept</p>', '<p class="social-policy">kept</p>', '<p data-class="ad">kept</p>'):
        assert html_text.main_text(f"<body><article>{ARTICLE}{p}</article></body>").endswith("\nkept")
    assert html_text.main_text("<p>a &am<b>p;</b> b &lt;c&gt;</p>") == "a &amp; b <c>"


def test_a_page_of_links_alone_keeps_them():
    assert html_text.main_text(f"<body><div>{LIST}</div></body>").count("Link number") == 20


def test_hostile_nesting_takes_linear_time():
    began = time.time()
    for page in ("<b><table><td>" + "<i>" * 40_000 + "</b>" * 40_000, "<div>" * 40_000 + "</p>" * 40_000, "<li>" * 40_000 + "<td>" * 40_000, "<ul><li>" * 40_000, "<h3>Comments</h3>" * 40_000, "<h3>" + "<b>" * 40_000 + "Comments"):
        html_text.main_text(page)
    assert time.time() - began < 60


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=40), st.text("abc ", min_size=1, max_size=40))
def test_edit_similarity(a, b):
    assert line_dedup.edit_similarity(a, b) == pytest.approx(1 - _levenshtein(a, b) / max(len(a), len(b)))


def test_distances_of_many_pairs():
    rng = random.Random(5)
    letters = [chr(x) for x in (*range(97, 123), *range(0x4E00, 0x4E60), 0x1F600)]
    lines, pairs, most = [], [], []
    for k in range(400):
        a = rng.choices(letters[: 26 if k % 2 else None], k=rng.choice((1, 5, 40, 64, 65, 150, 300)))
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 6 + 1)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choices(letters, k=rng.randint(0, 1))
        lines += ["".join(a), "".join(b)]
        pairs.append((2 * k, 2 * k + 1) if k % 3 else (2 * k, rng.randrange(2 * k + 1)))
        most.append(rng.choice((0, len(a) // 10, len(a) // 10, len(a))))
    points = np.frombuffer("\n".join(lines).encode("utf-32-le"), np.uint32)
    start, end = line_dedup._bounds(points)
    (a, b), most = np.array(pairs).T, np.array(most)
    got = line_dedup.edit_distances(points, (start[a], (end - start)[a]), (start[b], (end - start)[b]), most).tolist()
    want = [line_dedup.edit_distance(lines[x], lines[y]) for x, y in pairs]
    assert all(g == w if w <= m else g > m for g, w, m in zip(got, want, most.tolist(), strict=True))
    assert sum(w <= m for w, m in zip(want, most.tolist(), strict=True)) > 100


def test_estimates_are_near_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.85, 1.0):
        both = rng.integers(-(2**63), 2**63, int(4000 * share))
        own = [rng.integers(-(2**63), 2**63, 4000 - len(both)) for _ in range(2)]
        a, b = (np.unique(np.concatenate([both, x])) for x in own)
        got = near_dup.estimate(near_dup.sketch(a), near_dup.sketch(b)[None, :], len(a), np.array([len(b)], float))[0]
        assert got == pytest.approx(len(both) / (8000 - len(both)), abs=0.16)
    assert (near_dup.sketch(np.zeros(0, np.int64)) == near_dup.EMPTY).all() and near_dup.band_rows(0.85) == 5 and near_dup.band_rows(0.8) == 4


def test_rule_ensemble_learns_conjunctions():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] <= 0.4)).astype(float)
    model = quality_model.fit(x, y, ["a", "b", "c"])
    z = np.full(2000, model.bias)
    for rule, weight in model.rules:
        held = np.ones(2000, bool)
        for name, side, at in rule:
            v = x[:, "abc".index(name)]
            held &= v <= at if side == "<=" else v > at
        z += weight * held
    assert ((z > 0) == (y > 0)).mean() > 0.97
    assert quality_model.fit(x[:0], y[:0], ["a", "b", "c"]).rules == () and quality_model.fit(x, y * 0, ["a", "b", "c"]).rules == ()


def test_em_finds_junk_that_trips_one_rule():
    good, junk = (1, 1, 1, 1), [(0, 0, 1, 1), (1, 1, 0, 0), (1, 0, 1, 1)]
    prior, table = quality_rules.fit_em({good: 900, (1, 1, 1, 2): 50, **{j: 40 for j in junk}})
    assert prior > 0.8 and all(t[1][1] >= t[0][1] and t[0][0] >= t[1][0] for t in table)
    assert quality_rules.fit_em({})[1] == []


def test_known_licences_have_marks_and_own_digests():
    forms = {name: {licenses.canonical_text(t) for t in texts} for name, texts in licenses.KNOWN.items()}
    flat = [f for v in forms.values() for f in v]
    assert len(flat) == len(set(flat)) and all(re.search(licenses.MARKS, f) for f in flat)
