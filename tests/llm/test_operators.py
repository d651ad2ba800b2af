"""The operators over small tables: rows that are odd in every way, and brute force."""

import collections
import hashlib
import pathlib
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import decontaminate, html_text, licenses, line_dedup, mixing, near_dup, pii, quality_model, quality_rules, registry, token_files

SF = "/root/testdata/sf0.001"
W = r"[^\x20\x09-\x0D]+"
ODD = [
    (1, None, None), (2, "", "s"), (3, " \n\t ", "s"), (4, "one", None), (5, "one two", "s"), (5, "one two", "s"), (6, "x" * 300_000, "t"), (7, "a b c d e f g h i j\n" * 3000, "t"),
    (8, "word " * 2000 + "9" * 20_000 + " a@b.c " + "1." * 5000, "t"), (9, "Permission granted under licence\n\n", "ü"), (None, "no id here at all today friend", "s"), (10, "\x00퟿𝒳 émoji 😀 a@b.co +1 555 123 4567", "😀"),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    clash = ("_row", "_w", "_t", "size", "n_words", "shard", "leader", "bucket", "h", "score", "_words", "_copies", "lines", "kept", "part", "place", "component", "lang")
    return df.withColumns({c: F.lit(None).cast("string") for c in clash})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None)], "doc_id long, quality int").withColumn("text", F.lit("x"))


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "one two"), (2, None), (3, ""), (None, "word word word word word"), (4, "a b c d e f g"), (4, "a b c d e f g")], "item_id long, text string").withColumn("doc_id", F.lit(1))


def _operators(labels, items):
    return {
        "mix": mixing.mix, "mixed": mixing.mixed_documents, "lines": line_dedup.dedup_lines, "contaminated": lambda d: decontaminate.contaminated(d, items), "clean": lambda d: decontaminate.clean_documents(d, items),
        "near": near_dup.near_duplicates, "first": near_dup.first_of_each, "score": lambda d: quality_model.score(d, labels), "good": lambda d: quality_model.good_documents(d, labels), "label": quality_rules.label,
        "tokens": token_files.tokenise, "licenses": licenses.scan, "pii": pii.find,
    }


@pytest.mark.parametrize("name", _operators(None, None))
@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_and_empty_tables(spark, odd, labels, items, name, empty):
    docs = odd.limit(0) if empty else odd
    got = _operators(labels, items)[name](docs).collect()
    if empty:
        assert got == []
    elif name in ("mix", "lines", "near", "score", "label", "tokens", "pii", "licenses"):
        assert len(got) == len(ODD)
    if name in ("mixed", "clean", "first", "good"):
        assert _operators(labels, items)[name](docs).columns == odd.columns


def test_pages(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", "<p>a b</p>"), (1, None, None)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    assert sorted((r.text, r.n_chars) for r in html_text.extract(df).collect()) == [("", 0), ("", 0), ("a b", 3)]


def test_apportionment_against_all_quotients(spark):
    rng = np.random.default_rng(5)
    for seats in (1, 7, 50, 1000):
        votes = [int(v) for v in rng.integers(0, 1000, 12)]
        df = spark.createDataFrame([(i, v, seats) for i, v in enumerate(votes)], "party int, votes long, seats long")
        got = {r.party: r.won for r in mixing.sainte_lague(df, [], "party", "votes", "seats", "won").collect()}
        best = sorted(((v / (2 * k + 1), -i) for i, v in enumerate(votes) for k in range(seats) if v), reverse=True)[:seats]
        assert got == {i: sum(-j == i for _, j in best) for i in range(12)}


def test_targets_against_resharing(spark):
    sizes = [("b", 10), ("a", 1000), (None, 5), ("c", 500), ("d", 0)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, (s, _) in enumerate(order)}
    total, fixed, size = sum(n for _, n in sizes), {}, dict(sizes)
    while True:
        free = [s for s in size if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            break
        fixed |= {s: 3 * size[s] for s in over}
    assert got == pytest.approx(fixed | share)


def test_mix_comes_near_targets(spark):
    rows = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    taken = collections.Counter()
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[r.source] - r.target) <= max(2, 0.01 * r.target) for r in rows)
    assert sorted(rows) == sorted(mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_mixed_documents_come_near_targets(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    plan = mixing.mix(docs).groupBy("source").agg(F.first("target").alias("target"), F.max("size").alias("longest")).collect()
    words = collections.Counter()
    for r in mixing.mixed_documents(docs).select("source", "text").collect():
        words[r.source] += len(re.findall(W, r.text))
    for r in plan:
        assert abs(words[r.source] - r.target) <= r.longest + 0.02 * r.target, r.source


def _shingles(text, n, pattern=W, lower=lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)):
    w = re.findall(pattern, lower(text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_against_brute_force(spark, n, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    base = [f"w{i}" for i in range(400)]
    made = [(1000 + k, " ".join(f"z{k}" if (i * 7 + k) % 97 < k % 6 else w for i, w in enumerate(base))) for k in range(60)]
    docs = docs.union(spark.createDataFrame([*made, (2000, None), (2001, "A b"), (2002, "a B")], "doc_id long, text string"))
    sets = {r.doc_id: _shingles(r.text, n) for r in docs.collect()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= percent * max(len(sets[i]), len(sets[j])):
                k = len(sets[i] & sets[j])
                if k * 100 >= percent * (len(sets[i]) + len(sets[j]) - k):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs, n, percent).collect()}
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_decontamination_against_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet").select(k, "text") for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    some = items.first()
    w = some.text.split()
    extra = [(5000, "x y " + " ".join(w) + " z"), (5001, " ".join(w[: len(w) * 9 // 10]).upper()), (5002, " ".join(w[: len(w) // 2])), (5003, "lead tiny item tail"), (5004, None)]
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string"))
    items = items.union(spark.createDataFrame([(900, "Tiny, item!"), (901, None)], "item_id long, text string"))
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = set()
    for i in items.collect():
        n = min(5, len(words(i.text)))
        if not n:
            continue
        own = {tuple(words(i.text)[k : k + n]) for k in range(len(words(i.text)) - n + 1)}
        for d in docs.collect():
            x = words(d.text)
            k = len(own & {tuple(x[j : j + n]) for j in range(len(x) - n + 1)})
            if k * 100 >= 80 * len(own):
                want.add((d.doc_id, i.item_id, k, len(own)))
    got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == want and {(5000, some.item_id), (5003, 900)} <= {g[:2] for g in got} and not {5002, 5004} & {g[0] for g in got}


def test_an_empty_benchmark_finds_nothing(spark, items):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    none = items.limit(0).withColumn("item_id", F.col("item_id").cast("string"))
    got = decontaminate.contaminated(docs, none)
    assert got.collect() == [] and dict(got.dtypes)["item_id"] == "string" and decontaminate.clean_documents(docs, none).count() == 1


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_model.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_rule_statistics_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in quality_rules.label(docs).collect()}
    for d in docs.collect():
        w = re.findall(W, d.text)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        often, covered = collections.Counter(windows), set()
        for i, x in enumerate(windows):
            if often[x] > 1:
                covered.update(range(i, i + 5))
        lines = [x for x in d.text.split("\n") if re.search(W, x)]
        g = got[d.doc_id]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", d.text)), len(lines) - len(set(lines)), len(covered))
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (g.kept and g.base_failed)


def test_token_files_against_the_library(spark):
    P = pytest.importorskip("public_tokenizers")
    tokenizer = token_files.Encoder(P.path("byte_bpe_50k.json")).tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(-5, None), (9999, "")], "doc_id long, text string"))
    at = 0
    for d, g in zip(sorted(docs.collect(), key=lambda r: r.doc_id), sorted(token_files.tokenise(docs).collect()), strict=True):
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0]
        assert tuple(g) == (d.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_whole_licences_and_lines(spark):
    mit = "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + licenses._MIT.replace("sublicense", "sub" + "license").upper()
    rows = [(1, mit), (2, "text\nreleased  UNDER the MIT licence!\nmore"), (3, "nothing"), (4, "a license of no kind")]
    got = {r.doc_id: (r.license, r.line_licenses, r.n_license_lines) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("MIT", "", 0), 2: (None, "MIT", 1), 3: (None, "", 0), 4: (None, "", 0)}


def test_full_licence_texts(spark):
    folder = pathlib.Path("/usr/share/common-licenses")
    if not folder.is_dir():
        pytest.skip("no licence texts on this machine")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3"}
    rows = [(n, (folder / f).read_text()) for n, f in names.items()]
    rows.append(("GPL-2.0", rows[1][1].split("END OF TERMS AND CONDITIONS")[0] + "END OF TERMS AND CONDITIONS"))
    rows = [(i, text, n) for i, (n, text) in enumerate(rows)]
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, name string")).collect()}
    assert got == {i: n for i, _, n in rows}


def _luhn(x):
    d = [int(c) for c in reversed(x)]
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(d)) % 10 == 0


def test_base_spans_against_brute_force(spark):
    forms = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")), "card": 14 <= len(d) <= 19 and _luhn(d), "phone": 10 <= len(d) <= 15}[kind]

    odd = ["a@b.c_d@e.f x", "1.2.3.4.5.6.7.8 999.1.1.1 001.2.3.4", "4111 1111 1111 1111 é4111-1111-1111-1111 +49 30 1234567", "+1 (555) 123-4567 5", "9" * 3000, "x@y" + ".c" * 3000, "1." * 3000]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(9000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    for d in docs.collect():
        found = sorted((m.start(), i, m.end(), k) for i, (k, f) in enumerate(forms.items()) for m in re.finditer(f, d.text) if good(k, m[0]))
        g = got[d.doc_id]
        assert g.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{e}" for a, _, e, k in found).encode()).hexdigest()
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(x[3] == k for x in found) for k in forms]


def test_added_spans_need_checksum_or_context(spark):
    rows = [(1, "GB82 WEST 1234 5698 7654 32"), (2, "GB83 WEST 1234 5698 7654 32"), (3, "tel: 030 1234 5678"), (4, "sum 030 1234 5678"), (5, "ssn 123-45-6789"), (6, "no 123-45-6789")]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "iban:0:27", 2: "", 3: "local_phone:5:18", 4: "", 5: "ssn:4:15", 6: ""}


def test_context_words_around_spans_and_ibans_before_words(spark):
    far = "phone " + "a " * 20
    rows = [
        (1, "phone number: 020 7946 0958"), (2, "SSN is 123-45-6789"), (3, "call me at 555 123 4567"), (4, "555 123 4567 (fax)"), (5, "recall 555 123 4567"), (6, far + "555 123 4567"),
        (7, "tel 020 7946 0958, 020 7946 0959"), (8, "ES91 2100 0418 4502 0005 1332 BIC X"), (9, "GB82 WEST 1234 5698 7654 32 DE89 3704 0044 0532 0130 00"),
    ]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {
        1: "local_phone:14:27", 2: "ssn:7:18", 3: "local_phone:11:23", 4: "local_phone:0:12", 5: "", 6: "", 7: "local_phone:4:17,local_phone:19:32",
        8: "iban:0:29", 9: "iban:0:27,iban:28:55",
    }


def test_secrets_need_context_and_very_many_spans_take_linear_time(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    rows = [(1, f'token = "{key}" x'), (2, f"commit {key}"), (3, f"API_KEY: {key.upper()}"), (4, "password abcdefghijklmnopqrstuvwxyz"), (5, "a@b.co tel 020 7946 0958\n" * 40_000)]
    began = time.time()
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.time() - began < 120
    assert [got[i].spans for i in (1, 2, 3, 4)] == ["secret:9:49", "", "secret:9:49", ""]
    line = len("a@b.co tel 020 7946 0958\n")
    want = ",".join(f"email:{line * i}:{line * i + 6},local_phone:{line * i + 11}:{line * i + 24}" for i in range(40_000))
    assert got[5].n_email == 40_000 and got[5].spans == want


def test_line_groups(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark forest where nobody " * 4
    rows = [(1, base + "1\nshort\n" + base + "2"), (2, "An intro line of five words\n" + base.upper() + "3\nshort"), (3, "an INTRO line of five, words\nother words stand in this line")]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (base + "1\nshort", 1), 2: ("An intro line of five words\nshort", 1), 3: ("other words stand in this line", 1)}


def test_lines_with_a_changed_word(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(4, 8))) for _ in range(2000)]
    rows, pairs = [], 0
    for n in (12, 16, 20, 30, 50):
        for _ in range(40):
            line = list(rng.choice(words, n))
            other = [*line[:5], str(rng.choice(words)), *line[6:]]
            if line != other and line_dedup.edit_similarity(" ".join(line), " ".join(other)) >= 0.9:
                rows += [(len(rows), " ".join(line)), (len(rows) + 1, " ".join(other))]
                pairs += 1
    gone = sum(r.n_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert pairs > 150 and 0.97 * pairs <= gone <= pairs


def test_query_groups_short_lines_and_scripts_without_spaces(spark, tmp_path):
    han = "这是一个没有空格的很长的句子用来测试重复的行"
    rows = [(1, f"Yes\n--\n{han}"), (2, f"yes!\n--\n{han}吗"), (3, "No\nno")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in registry.queries()["op3_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: f"Yes\n--\n{han}", 2: "--", 3: "No"}


def test_queries_are_registered(spark):
    numbers = {int(re.match(r"op(\d+)_", k)[1]) for k in registry.queries()}
    assert numbers == set(range(1, 11))


def test_near_duplicates_of_a_bucket_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "PART", 7)
    monkeypatch.setattr(near_dup, "MEMBERS", 5)
    base = [f"w{i}" for i in range(300)]
    rows = [(k, " ".join(f"z{k}" if (i * 7 + k) % 97 < k % 4 else w for i, w in enumerate(base))) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: _shingles(t, 3) for i, t in rows}
    label = {i: i for i in sets}
    for _ in range(len(sets)):
        new = {i: min(label[j] for j in sets if len(sets[i] & sets[j]) * 100 >= 85 * len(sets[i] | sets[j])) for i in sets}
        if new == label:
            break
        label = new
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, 3, 85).collect()} == label and len(set(label.values())) < 80


def test_a_link_across_parts_of_a_bucket_where_stand_ins_have_none(spark, monkeypatch):
    """The first stands for the second in one part, the third for the fourth in the other; only the second and the fourth link the two parts."""
    monkeypatch.setattr(near_dup, "PART", 2)
    base = {i: f"w{i}" for i in range(300)}
    unlike = lambda tag, places: {i: f"{tag}{i}" for i in places}
    y = base | unlike("y", range(24))
    texts = [base | unlike("n", (144, 179, 76, 226)), base, y | unlike("m", (269, 103, 70, 58)), y]
    sets = [set(t.values()) for t in texts]
    linked = {(i, j) for i in range(4) for j in range(i) if len(sets[i] & sets[j]) * 100 >= 85 * len(sets[i] | sets[j])}
    assert linked == {(1, 0), (3, 2), (3, 1)}
    docs = spark.createDataFrame([(i, " ".join(t.values())) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, 1, 85).collect()} == dict.fromkeys(range(4), 0)


def test_links_of_a_large_group_are_few(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "MEMBERS", 5)
    counts, found = [], near_dup._links
    monkeypatch.setattr(near_dup, "_links", lambda *given: (links := found(*given), counts.append(links.distinct().count()))[0])
    # Every document lacks a stretch of the text: neighbours are linked, those far from each other aren't.
    n = 120
    rows = [(k, " ".join(f"z{k}" if k * 900 // n <= i < k * 900 // n + 70 else f"w{i}" for i in range(1000))) for k in range(n)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert {r.component_id for r in got} == {0} and len(got) == n and counts[0] < 2 * n


def test_fuzzy_lines_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = sorted((d.doc_id, k, line_dedup.normalise(x)) for d in docs.collect() for k, x in enumerate((d.text or "").split("\n")))
    lines = sorted({x for *_, x in rows if x}, key=len)
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = []
    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            if len(b) * 9 > len(a) * 10:
                break
            # Letters that one line has and the other hasn't take an edit for every two of them at least.
            far = sum((collections.Counter(a) - collections.Counter(b)).values())
            if len(b) >= line_dedup.MIN_CHARS and far * 10 <= len(b) and line_dedup.edit_distance(a, b, len(b) // 10) * 10 <= len(b):
                pairs.append((a, b))
                root[find(a)] = find(b)
    first = {}
    for d, k, x in rows:
        if x:
            first.setdefault(find(x), (d, k))
    gone = {(d, k) for d, k, x in rows if x and first[find(x)] != (d, k)}
    found = {(r.doc_id, k) for r in line_dedup.repeated_lines(docs, min_words=1).collect() for k in r.lines}
    assert len(pairs) > 20 and found <= gone and len(found) >= 0.97 * len(gone)
    fuzzy = {(d, k) for d, k, x in rows if x and any(x in p for p in pairs)} & gone
    assert len(fuzzy & found) >= 0.9 * len(fuzzy)


def test_lines_of_a_hot_block_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(14)]
    rows = [(i, " ".join([*base[: 5 + i % 5], f"x{i}", *base[6 + i % 5 :]])) for i in range(40)] + [(50, "quite another line of words that is like none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(r.doc_id, tuple(r.lines)) for r in line_dedup.repeated_lines(docs).collect()}
    monkeypatch.setattr(line_dedup, "SAMPLE", 1)
    monkeypatch.setattr(line_dedup, "HOT", 3)
    monkeypatch.setattr(line_dedup, "PART", 4)
    assert {(r.doc_id, tuple(r.lines)) for r in line_dedup.repeated_lines(docs).collect()} == want and len(want) == 39


def test_lines_with_many_edits_close_together_are_linked(spark):
    """No eight characters agree over a stretch of eighty, in which each seventh is another."""
    rng = np.random.default_rng(11)
    rows = []
    for k in range(30):
        line = "".join(chr(97 + x) for x in rng.integers(0, 26, 200))
        other = "".join("0" if 40 <= i < 124 and i % 7 == 0 else c for i, c in enumerate(line))
        rows += [(k, 2, 2 * k, line), (k, 2, 2 * k + 1, other)]
    got = line_dedup._verified(spark.createDataFrame(rows, "slot long, side int, node long, text string").coalesce(1), 90)
    assert {(r.a, r.b) for r in got.collect()} == {(2 * k, 2 * k + 1) for k in range(30)}


def test_lines_that_links_hold_together_are_tied_to_the_first(spark):
    """Each line links with the next alone; ways between tied lines are one link long, so that components take few rounds."""
    letters = "".join(chr(97 + x) for x in np.random.default_rng(12).integers(0, 26, 200))
    lines = ["".join("0" if i < 15 * k else c for i, c in enumerate(letters)) for k in range(5)]
    rows = [(1, 2, k, t) for k, t in enumerate(lines)]
    got = line_dedup._verified(spark.createDataFrame(rows, "slot long, side int, node long, text string").coalesce(1), 90)
    assert sorted((r.a, r.b) for r in got.collect()) == [(0, k) for k in range(1, 5)]


def test_links_whose_registers_look_unlike_share_a_group(spark):
    shared = [(r << 40) + (1 << 39) + r for r in range(368)]
    own = [[(r << 40) + 1 for r in range(first, first + 32)] for first in (0, 32)]  # the least of their registers
    sets = [np.array(shared + x, np.int64) for x in own]
    assert len(shared) * 100 >= 85 * (len(shared) + 64)
    rows = [(k, len(v), bytearray(near_dup.sketch(v).tobytes()), [1]) for k, v in enumerate(sets)]
    # The third is not kept for comparing where it stands for the second, which resembles the fourth less.
    base = np.arange(near_dup.REGISTERS, dtype=np.uint16)
    for k, changed in enumerate((0, 7, 47)):
        s = base.copy()
        s[:changed] += 500
        rows.append((k + 2, 252, bytearray(s.tobytes()), [2]))
    stars = near_dup._stars(spark.createDataFrame(rows, "doc_id long, n_shingles long, sketch binary, bands array<long>"), 0.85)
    assert {(r.leader, r.doc_id) for r in stars.collect()} == {(0, 0), (0, 1), (2, 2), (2, 3), (2, 4)}
