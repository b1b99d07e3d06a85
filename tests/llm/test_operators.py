"""Each operator against a plain version of its contract, on small fixtures with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from lexigrid.llm import components, decontaminate, html_extract, line_rules, mixing, quality_model, rlz_dedup, simhash, suffix_dedup, token_files, url_filter, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice(['ta', 'ré', 'ö', 'no'])}{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passage = prose(rng, 70)
    texts = [prose(rng, rng.randrange(20, 160)) for _ in range(30)]
    texts += [f"{prose(rng, 30)} {passage}\n{prose(rng, 20)}" for _ in range(6)]
    texts += [texts[3]] * 4 + [texts[4] + " extra", texts[4].replace(" ", "  ", 3), None, None, "", " \n\t ", "one", "a b c", "the " * 300, "ab" * 400, prose(rng, 3000), passage]
    texts += ["x y " * 40 + passage + " x y" * 40, "line one here\nline one here\nother line", "A&B | #tag <i> 100% $5*"]
    out = [(i, t, "en", f"s{i % 4}" if i % 7 else None, 0) for i, t in enumerate(texts)]
    out += [out[3], out[5], (None, texts[5], None, "s1", None), (None, passage, None, None, None), (7, "another text under a used id " * 20, "en", "s1", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    # columns whose names the operators use inside
    clash = {c: F.lit("x") for c in ("key", "fp", "start", "pack", "words", "_block", "_of", "_take", "gram", "text_hash", "count", "score", "host", "line")}
    return spark.createDataFrame(rows, DOCS).withColumns(clash).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def by_row(frame, *columns):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in frame.select(*columns).collect())


# --- near duplicates


def plain_print(text):
    words = [w.encode() for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, errors=4):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= errors:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_groups(docs, rows):
    prints = [plain_print(r[1]) for r in rows]
    root = classes(prints)
    least = {}
    for (i, *_), c in zip(rows, root):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = Counter((r[0], f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, root))
    assert by_row(simhash.simhash_groups(docs), "doc_id", "fingerprint", "component_id") == want


@pytest.mark.parametrize("limit", [40_000, 20])
def test_trie_join_finds_every_link_of_dense_groups(spark, limit):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 5, np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for c in centres for _ in range(60)]
    far = [int(x) for x in rng.integers(0, 1 << 63, 100, np.uint64)]
    prints = sorted(set(near + far))
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    labels = {r.node & (1 << 64) - 1: r.label for r in components.component_labels(simhash.near_links(frame, 4, limit)).collect()}
    root = classes(prints)
    groups, want = {}, {}
    for p, c in zip(prints, root):
        groups.setdefault(labels.get(p, p), set()).add(p)
        want.setdefault(c, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_deduplicated_keeps_one_document_of_each_group(docs, rows):
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    prints = [plain_print(r[1]) for r in rows]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    text_hash = {r.text: r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    least = {}
    for (i, t, *_), p, c in zip(rows, signed, classes(prints)):
        if i is not None:
            least[c] = min((i, p, text_hash[t], t), least.get(c, (i, p, text_hash[t], t)))
    want = Counter((i, t) for i, _, _, t in least.values()) + Counter((None, r[1]) for r in rows if r[0] is None)
    assert by_row(kept, "doc_id", "text") == want
    # nothing is repeated here, so rows are kept without a shuffle of texts
    once = docs.filter("doc_id < 20 and doc_id not in (3, 5, 7)")
    assert simhash.deduplicated(once).count() == len({c for (i, *_), c in zip(rows, classes(prints)) if i in range(20) and i not in (3, 5, 7)})


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.label for r in components.component_labels(edges).collect()} == {0}


# --- substrings


def test_rlz_removes_what_earlier_documents_hold(docs, rows):
    first = {}
    words = [WORD.findall(r[1] or "") for r in rows]
    for (i, *_), w in zip(rows, words):
        for k in range(len(w) - 49 if i is not None else 0):
            first[tuple(w[k : k + 50])] = min(i, first.get(tuple(w[k : k + 50]), i))
    want = Counter()
    for (i, *_), w in zip(rows, words):
        gone = {p for k in range(len(w) - 49) if i is not None and first[tuple(w[k : k + 50])] < i for p in range(k, k + 50)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        want[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert by_row(rlz_dedup.deduplicated(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert sum(n[2] for n in want) > 500


@pytest.mark.parametrize("bucket", [40_000, 12])
def test_suffix_array_removes_repeated_bytes(docs, rows, bucket):
    texts = [(r[1] or "").encode() for r in rows]
    count = Counter(t[k : k + 200] for t in texts for k in range(len(t) - 199))
    want = Counter()
    for (i, *_), t in zip(rows, texts):
        gone = {p for k in range(len(t) - 199) if count[t[k : k + 200]] > 1 for p in range(k, k + 200)}
        spans = sum(p - 1 not in gone for p in gone)
        want[i, len(t), len(gone), 2 * spans, hashlib.sha256(bytes(b for p, b in enumerate(t) if p not in gone)).hexdigest()] += 1
    got = suffix_dedup.deduplicated(docs, bucket=bucket).withColumn("n", F.size("spans"))
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n", "kept_sha256") == want


def test_stretches_partition_all_windows():
    rng = np.random.default_rng(3)
    units = rng.integers(0, 3, 5000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    lengths = np.array([10, 0, 700, 39, 40, 4211])
    found = windows.stretches(lambda a, b: units[a:b], lengths, 40, 8)
    seen = Counter((int(d), int(s) + k) for d, s, n in zip(found.doc, found.start, found.count) for k in range(n))
    assert seen == Counter((d, s) for d, n in enumerate(lengths) for s in range(max(0, n - 39)))
    assert ((found.anchor >= found.start + found.count - 1) & (found.anchor + 8 <= found.start + 40)).all()


def test_multikey_order_sorts_by_all_keys():
    rng = np.random.default_rng(2)
    keys = [rng.integers(0, n, 500).astype(np.uint64) for n in (3, 4, 1000)]
    order = suffix_dedup.multikey_order(keys)
    assert (np.lexsort(keys[::-1]) == order).all() or [tuple(int(k[i]) for k in keys) for i in order] == sorted(zip(*(k.tolist() for k in keys)))


# --- benchmark


def bench_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


@pytest.mark.parametrize("block", [200_000, 40])
def test_contamination(spark, docs, rows, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    long = next(r[1] for r in rows if r[1] and len(r[1]) > 10_000)
    items = [(1, " ".join(long.split()[40:60]).upper()), (10, "ONE"), (2, "a-b, C"), (3, None), (4, "..."), (5, rows[30][1][-300:]), (5, rows[30][1][-300:]), (None, "line one"), (6, "nowhere to be found")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    grams = []
    for i, t in items:
        w = bench_words(t)
        n = min(13, len(w))
        grams += [("" if i is None else str(i), w[k : k + n]) for k in range(len(w) - n + 1) if n]
    want = Counter()
    for r in rows:
        w, hit, found = bench_words(r[1]), set(), set()
        for i, g in grams:
            for k in range(len(w) - len(g) + 1):
                if w[k : k + len(g)] == g:
                    hit.update(range(k, k + len(g)))
                    found.add(i)
        want[r[0], len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    assert by_row(decontaminate.contamination(docs, bench), "doc_id", "n_words", "n_hit", "items", "contaminated") == want
    clean = decontaminate.decontaminated(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == sum((Counter({k[0]: n}) for k, n in want.items() if not k[4]), Counter())
    cut = decontaminate.decontaminated(docs.filter("text like '%line one%'"), bench, spans=True).select("text").first()[0]
    assert "one" not in cut and cut.endswith("other line")


def test_no_benchmark_leaves_documents_alone(spark, docs, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, bench).filter("contaminated").isEmpty()
    assert decontaminate.contamination(none, bench).isEmpty()


# --- quality


def plain_base(text):
    text = text or ""
    w = WORD.findall(text)
    count = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {p for i in range(len(w) - 4) if count[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_base_statistics(docs, rows):
    want = Counter()
    for r in rows:
        base = plain_base(r[1])
        want[(r[0], *base, base[0] < 10 or 100 * base[4] > 20 * base[0])] += 1
    assert by_row(line_rules.judged(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want


def test_lines_of_a_host_are_counted_across_documents(spark):
    rng = random.Random(2)
    body = [prose(rng, 30) for _ in range(12)]
    rows = [(i, f"Share  this page {i} with all your friends\n{body[i]}", "a") for i in range(8)]  # digits do not tell lines apart
    rows += [(20 + i, "\n".join(["share this page 0 with all your friends"] * 9 + ["a few other words"]), "a") for i in range(2)]
    rows += [(30 + i, f"share this page 1 with all your friends\n{body[8 + i]}", None) for i in range(3)] + [(31, rows[0][1], "a")] * 2
    got = line_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string"), max_docs=4, max_share=4).collect()
    by = {(r.doc_id, r.host): r for r in got}
    assert len(got) == len(rows) and by[0, "a"].n_boilerplate == 8 and by[0, "a"].kept
    assert not by[20, "a"].kept and by[20, "a"].n_boilerplate == 72
    assert by[30, None].n_boilerplate == 0


def test_quality_model_separates_held_out_documents(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        good, text = i % 3 > 0, prose(rng, rng.randrange(30, 200), 3000)
        if not good:
            text = [text.upper(), " ".join(w for w in text.split()[:20] for _ in range(9)), text.replace(" ", "### ")][i % 9 // 3]
        rows.append((i, text if i % 50 else None))
        labels.append((i, int(good), 0))
    labels += [(9999, 1, 0), (None, 1, 0), (1, None, 0), (2, 1, 0), (2, 1, 0)]
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    trees = quality_model.fit_quality(docs, lab.filter("doc_id % 4 != 1"))
    scores = {r.doc_id: r.score for r in quality_model.quality_scores(docs, trees).collect()}
    held = [i for i in range(600) if i % 4 == 1 and i % 50]
    assert np.mean([(scores[i] >= 0.5) == (i % 3 > 0) for i in held]) > 0.95 and all(0 <= s <= 1 for s in scores.values())
    again = {r.doc_id: r.score for r in quality_model.quality_scores(docs.repartition(7), quality_model.fit_quality(docs.repartition(5), lab.filter("doc_id % 4 != 1"))).collect()}
    assert again == scores
    kept = {r.doc_id for r in quality_model.accepted(docs, trees).collect()}
    assert kept == {i for i, s in scores.items() if s >= 0.5}
    one = quality_model.fit_quality(docs, lab.filter("quality = 1"))
    assert quality_model.quality_scores(docs, one).filter("score < 0.99").isEmpty()
    assert quality_model.quality_scores(docs, quality_model.fit_quality(docs, lab.filter("false"))).select("score").distinct().collect()[0][0] == 0.5


def test_trees_walk_like_their_nodes():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 4))
    trees = quality_model.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float))

    def one(row):
        total = trees.base
        for t in range(len(trees.value)):
            node = 0
            while trees.left[t, node] != node:
                node = trees.left[t, node] if row[trees.feature[t, node]] <= trees.threshold[t, node] else trees.right[t, node]
            total += trees.value[t, node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [one(r) for r in x]) and ((trees.score(x) > 0.5) == (x[:, 0] * x[:, 1] > 0)).mean() > 0.95


# --- mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left, w = total - sum(3 * sizes[s] for s in capped), sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / w for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_takes_come_near_their_targets(docs, rows):
    got = mixing.takes(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = plain_targets(dict(sizes))
    assert len(got) == len(rows)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * want[s] + 1e-9 and r.taken <= 3 * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(r.size for r in mine)
    assert Counter(got) == Counter(mixing.takes(docs.repartition(5)).collect())


def test_takes_are_counted_in_the_mix(docs, monkeypatch):
    want = Counter(mixing.takes(docs, depth=3).collect())
    assert want == Counter(mixing.takes(docs).collect())
    place = mixing.placed_blocks
    monkeypatch.setattr(mixing, "placed_blocks", lambda drawn, depth: place(drawn, 3).filter("shard < 4"))
    half = mixing.takes(docs).collect()
    total = sum(r.taken * n for r, n in want.items())
    assert len(half) == sum(want.values()) and 0.2 * total < sum(r.taken for r in half) < 0.8 * total
    monkeypatch.setattr(mixing, "placed_blocks", lambda drawn, depth: place(drawn, depth).filter("false"))
    assert mixing.takes(docs).agg(F.sum("taken")).first()[0] == 0


def test_sources_that_stop_at_their_cap(spark):
    sizes = {"a": 1000, "b": 3, "c": 50, "d": 0, None: 7}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 for s in want)


def test_mixture_repeats_what_is_taken(docs):
    took = Counter()
    for r in mixing.takes(docs).filter("size > 0 and taken > 0").collect():
        took[r.doc_id] += r.taken // r.size
    mix = mixing.mixed(docs, depth=2)
    assert mix.columns == docs.columns
    assert Counter(r.doc_id for r in mix.filter(F.regexp_like("text", F.lit(r"[^ \t\n\x0b\f\r]"))).collect()) == took


def test_split_quotas_are_exact(spark):
    quotas = {1: 100, 2: 37, 3: 1, 4: 22}
    rows = mixing.split_quotas(spark.createDataFrame(list(quotas.items()), "rank int, n long"), 3).collect()
    by_rank, by_shard = Counter(), Counter()
    for r in rows:
        by_rank[r["rank"]] += r.n
        by_shard[r.shard] += r.n
    assert by_rank == quotas and set(by_shard.values()) == {20} and len(by_shard) == 8
    assert sum(r.n for r in rows if r["rank"] == 1 and r.shard < 4) in range(35, 66)


# --- token files


def test_token_files_round_trip(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted(token_files.token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), 2, files=3).collect(), key=lambda r: r.start)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, row in zip(got, ordered, strict=True):
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("text", ["it's  two", " lead", "trail ", "a\n\nb", "x\u00a0y z", "don't we'll\nI'm", "<|endoftext|> a", "1 2,3 !!? ...", "é\u0301 ñ 漢字 😀 k", "tab\tbed", "a \n b", "\u2028 x"])
def test_words_are_encoded_as_in_their_text(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_files.Encoder(path, 2)
    got = np.frombuffer(encoder.encode([text, text + " again"])[0], encoder.dtype).tolist()
    assert got == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids + [2]


# --- pages


def test_url_parts_and_rules(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
    cases = [
        ("http://Example.COM/en/1?q=/x#y", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("https://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
        ("https://example.com", "example.com", "", None, None),
        ("x://ÀB.net/es/a://b", "Àb.net", "/es/a://b", "net/es/", "block"),
        ("http://h.net?x=/es/", "h.net", "", None, None),
        ("no scheme/net/es/", "", "", None, None),
        (None, "", "", None, None),
    ]
    frame = spark.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(cases)], "page_id long, url string, host string, path string")
    host, path = url_filter.parts(F.col("url"))
    fit = url_filter.fitting_rule(F.col("h"), F.col("p"), rules)
    got = frame.select("page_id", host.alias("h"), path.alias("p")).withColumn("fit", fit).select("h", "p", "fit.rule", "fit.verdict", "page_id").orderBy("page_id").collect()
    assert [tuple(r)[:4] for r in got] == [c[1:] for c in cases]


def test_url_model_blocks_unwanted_hosts(spark):
    hosts = [f"{a}{b}.example.net" for a in ("ther", "tion", "oula") for b in ("an", "ish", "oft", "ere")] + ["casino-win.example.net", "m.spam-farm.example.org"]
    pages = spark.createDataFrame([(i, f"https://{h}/en/{i}") for i, h in enumerate(hosts)] + [(99, None), (99, None)], "page_id long, url string")
    model = url_filter.fit_urls(url_filter.labelled_urls(pages.select("url")))
    got = url_filter.judged_urls(pages, [], model).collect()
    assert len(got) == len(hosts) + 2
    assert {r.host for r in got if r.verdict == "block"} - {""} == {"casino-win.example.net", "m.spam-farm.example.org"}
    assert url_filter.judged_urls(pages.filter("false"), [], model).isEmpty()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies on this site and many others.</div>
%s<aside>Aside text that is long enough to be seen</aside><div id="comments"><p>First! What a great article this is.</p></div><form><label>Mail</label><input></form>
<footer>&copy; all rights</footer></body></html>"""


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        ("<article><h1>A &amp; B</h1><p><b>One\n two<br><p>Three &lt;3 <p>Four</article>", "A & B\nOne two\nThree <3\nFour"),
        ("<div class='content-main'><h2>Head</h2><div><p>A long first paragraph of the text.</p><p>And a second one, too.</p></div><div><p>Another section with some more words.</p></div></div>", "Head\nA long first paragraph of the text.\nAnd a second one, too.\nAnother section with some more words."),
        ("<main><p>x</p><div class='ad'>Buy this very good and cheap thing now, only today and only here for you!</div><ul><li>a<li>b</ul></main>", "x\na\nb"),
        ("<article></article>", ""),
    ],
)
def test_main_text(inner, want):
    assert html_extract.main_text(PAGE % inner) == want


def test_odd_pages(spark):
    pages = [None, "", "just text", "<p>open <b>bold", "<article><p>a</p", "<div>" * 3000 + "deep", "<p>x" + "y" * 200_000, "</p></div>", "<a b='c>d</a> e"]
    frame = spark.createDataFrame([(i, None, h, "z") for i, h in enumerate(pages)] + [(2, None, "just text", "z")], "page_id long, url string, html string, text string")
    got = html_extract.extracted(frame).orderBy("page_id").collect()
    assert len(got) == 10 and [r.text for r in got[:5]] == ["", "", "just text", "just text", "open bold"] and got[7].n_chars == 200_001
    assert all(r.n_chars == len(r.text) for r in got) and html_extract.extracted(frame.filter("false")).isEmpty()


# --- all


def test_empty_tables(none):
    assert simhash.simhash_groups(none).isEmpty() and simhash.deduplicated(none).isEmpty()
    assert rlz_dedup.deduplicated(none).isEmpty() and suffix_dedup.deduplicated(none).isEmpty()
    assert line_rules.judged(none).isEmpty() and mixing.takes(none).isEmpty() and mixing.mixed(none).isEmpty()
    assert token_files.token_files(none, public_tokenizers.path("byte_bpe_50k.json"), 2).isEmpty()
    assert quality_model.quality_scores(none, quality_model.fit_trees(np.zeros((0, len(quality_model.FEATURES))), np.zeros(0))).isEmpty()


@pytest.mark.parametrize("limit", [1, 7, 100, 10_000])
def test_slices_by_bytes_are_whole_and_never_empty(limit):
    import pyarrow as pa

    texts = [b"x" * n for n in (0, 5, 0, 300, 1, 1, 1, 0)]
    batch = pa.RecordBatch.from_pydict({"t": pa.array([*texts, None], pa.binary())})
    parts = list(windows.by_bytes(iter([batch, batch.slice(0, 0)]), 0, limit))
    assert all(p.num_rows for p in parts) and pa.Table.from_batches(parts).column(0).to_pylist() == [*texts, None]
