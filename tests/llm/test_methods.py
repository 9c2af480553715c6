"""Each method against a plain loop, a round trip, or held-out labels."""

from __future__ import annotations

import collections
import html
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import tables
from tidemark.llm import compression, decontamination, htmltext, kernels, langid, licenses, lm, mixing, neardup
from tidemark.llm import quality_rules, toxicity
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES

SF = tables.SF


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


# -- kernels ----------------------------------------------------------------------


def test_words_and_shingles_like_a_plain_split():
    texts = ["Hello  World", "", None, " a b c d e f a b c d e ", "É\x0bé x", "x"] * 5
    powers, seen = kernels.Powers(), {}
    for limit in (1, 20, 1 << 20):
        for a, b, data, offsets in kernels.pieces(pa.array(texts), limit):
            starts, ends, before = kernels.words(data, offsets)
            hashes, _ = kernels.word_hashes(data, offsets, powers)
            found, cuts = kernels.shingles(hashes, before, 5)
            for i in range(b - a):
                own = tables.SPACE.findall(texts[a + i] or "")
                at = range(before[i], before[i + 1])
                assert [bytes(data[starts[k] : ends[k]]).decode() for k in at] == own
                for k, word in zip(at, tables.words(texts[a + i])):
                    assert seen.setdefault(word, hashes[k]) == hashes[k]
                n = len(own)
                assert cuts[i + 1] - cuts[i] == (n - 4 if n >= 5 else min(n, 1))
    assert len(set(seen.values())) == len(seen)


# -- 1: languages -----------------------------------------------------------------


def test_held_out_languages(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98


def test_mixtures_of_two_languages(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    model = langid.learn(docs)
    texts = {r["lang"]: r["text"] for r in docs.filter("length(text) BETWEEN 2000 AND 3000").collect()}
    both = texts["en"][:1800] + " " + texts["de"][:900]
    work = langid._predictor(model)
    lang, score, number, mixture, _ = (x.to_pylist() for x in work(pa.array([both, texts["fr"]])))
    assert lang == ["en", "fr"] and number == [2, 1]
    shares = dict(part.split(":") for part in mixture[0].split(","))
    assert abs(float(shares["en"]) - 2 / 3) < 0.1 and abs(score[0] - 2 / 3) < 0.1


def test_a_slope_below_the_penalty_means_one_language():
    rng = np.random.default_rng(1)
    for _ in range(50):
        log_p = np.log(rng.dirichlet(np.ones(40), size=3)).astype(np.float32)
        bucket = rng.integers(0, 40, 60)
        ll = log_p[:, bucket].sum(axis=1) / langid.GRAM
        best = int(ll.argmax())
        slope = max((np.exp(log_p[m] - log_p[best])[bucket] - 1).sum() / langid.GRAM for m in range(3))
        _, mixed = langid._em(np.exp(log_p[:, bucket].T.astype(float)), np.full(60, 1 / langid.GRAM), np.ones(3) / 3, 500)
        assert mixed - ll[best] <= slope + 1e-6


# -- 2: language model ------------------------------------------------------------


def test_model_against_counting_in_dictionaries(spark):
    rows = [(r["doc_id"], tables.words(r["text"]) + ["</s>"]) for r in documents(spark).collect()]
    one, two = collections.Counter(), collections.Counter()
    for i, w in rows:
        if tables.crc(i) % 7 != 2:
            one.update(w)
            two.update(zip(["<s>", *w], w))
    n, v = sum(one.values()), len(one)
    ways, total, kinds = collections.Counter(b for _, b in two), collections.Counter(), collections.defaultdict(lambda: [0] * 4)
    for (a, _), c in two.items():
        total[a] += c
        kinds[a][min(c, 3)] += 1
    d = lm.discounts([sum(c == k for c in two.values()) for k in (1, 2, 3, 4)])
    e = lm.discounts([sum(c == k for c in ways.values()) for k in (1, 2, 3, 4)])
    all_ways = sum(ways.values())
    rest = sum(e[min(c, 3)] for c in ways.values()) / all_ways

    def p(a, b):
        low = max(ways[b] - e[min(ways[b], 3)], 0) / all_ways + rest / (v + 1)
        if not total[a]:
            return low
        c = two[a, b]
        return max(c - d[min(c, 3)], 0) / total[a] + sum(d[k] * kinds[a][k] for k in (1, 2, 3)) / total[a] * low

    assert sum(p("the", w) for w in one) + p("the", "no such word") == pytest.approx(1)
    got = {r["doc_id"]: r for r in lm.evaluate(documents(spark)).collect()}
    for i, w in rows:
        assert got[i]["score"] == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(["<s>", *w], w)), rel=1e-9)
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        assert got[i]["n_tokens"] == len(w) and got[i]["n_known"] == sum(one[x] > 0 for x in w)
        assert got[i]["train_tokens"] == n and got[i]["held_out"] == (tables.crc(i) % 7 == 2)


def test_hot_words_are_spread_over_shards(spark):
    rows = [(i, " ".join(f"the w{i}x{k}" for k in range(300)), "en", "s") for i in range(30)]
    docs = tables.frame(spark, rows)
    model = lm.learn(docs)
    assert len(model.layout.hot) and model.layout.spread.max() > 1
    arrays, powers = lm.Arrays(model.layout), kernels.Powers()
    for _, tokens, cuts in lm._sequences(pa.array([rows[0][1]]), powers):
        _, count, _ = lm.log_probabilities(model, arrays, tokens, cuts)
        pairs = arrays.pairs(lm._previous(tokens, cuts), tokens)
        assert count.min() >= 1 and pairs.min() >= 1 and pairs.max() == 1 or pairs.max() == 30


# -- 3: pages ---------------------------------------------------------------------


def test_pages_against_their_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = (html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article)))
        want[r["page_id"]] = "\n\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)
    got = {r["page_id"]: r["text"] for r in QUERIES["op3_html_main_text"](spark, SF).collect()}
    assert got == want


UNMARKED = (
    "<html><head><title>T</title></head><body><header><h1>Site</h1></header><div id='cookie-notice'>We use cookies"
    " for everything</div><div class=content><h2>Title here</h2><p>First part with a <a href=x>link</a> &amp; more"
    " words\n here.<div class='ad-box'>Buy now</div><p>Second part goes on and on.<ul><li>one item<li>two</ul></div>"
    "<aside>Related things to look at</aside><section class=comments><p>I think this is a great article</section>"
    "<form>Name <input></form><footer>Copyright by nobody</footer></body></html>"
)


def test_pages_without_marks():
    assert htmltext.extract(UNMARKED) == (
        "Title here\n\nFirst part with a link & more words here.\n\nSecond part goes on and on.\n\none item\n\ntwo"
    )
    for page in ("<", "<p", "</p>", "<!--", "<script>x", "<a href='", "&", "<div><div></p>"):
        htmltext.extract(page)


def test_marked_content_stays_whole():
    first, last = (tables.sentence(k, 100) for k in (1, 2))
    weak = htmltext.Weights({"word": 0.2, "link": -2.0, "boiler": -2.0, "tag": -1.0})
    for weights in (htmltext.DEFAULT, weak):
        for sign in ("has-sidebar", "no-comments", "search"):
            page = f"<body><div class='{sign}'><nav>Menu</nav><article><p>{first}</article><div class=comments>so so</div></div>"
            assert htmltext.extract(page, weights) == first
        page = f"<article><p>{first}</p><aside>{tables.sentence(3, 400)}</aside><div class=ad>Buy {last}</div><p>{last}</p></article>"
        assert htmltext.extract(page, weights) == f"{first}\n\n{last}"
        page = f"<body><p>Site<article><h1><a href=x>Title</a></h1><p>{first}</p><p><a href=y>{last}</a></p></article>"
        assert htmltext.extract(page, weights) == f"Title\n\n{first}\n\n{last}"
    assert htmltext.extract(f"<body><nav>Menu</nav><div class=has-sidebar><p>{first}</p></div>") == first
    assert htmltext.extract(f"<body><div hidden><p>{first}</p></div>") == ""


def test_best_run_like_trying_all():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.randint(-5, 5) for _ in range(rng.randint(0, 9))]
        a, b = htmltext.best_run(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0)
        assert sum(scores[a:b]) == max(best, 0)


# -- 4: near-duplicates -----------------------------------------------------------


def brute_components(rows):
    sets, parent = {}, {}
    for i, text in rows:
        w = tables.words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_rows() -> list[tuple]:
    rng, rows = random.Random(5), []
    passage = tables.sentence(0, 50).split()
    for group in range(12):
        base = tables.sentence(100 + group, rng.choice([3, 6, 40, 120])).split()
        for _ in range(rng.choice([1, 2, 5, 40])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(["Alpha", "beta"])
            rows.append((len(rows), " ".join(own).upper() if rng.random() < 0.1 else "  ".join(own), "en", "s"))
    for k in range(80):  # one passage in many texts that are otherwise different
        rows.append((len(rows), " ".join(passage + tables.sentence(1000 + k, rng.randint(2, 60)).split()), "en", "s"))
    return rows


def test_components_against_all_pairs(spark):
    rows = near_rows()
    want = brute_components([(r[0], r[1]) for r in rows])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(tables.frame(spark, rows)).collect()}
    assert got == want
    want = brute_components([(r["doc_id"], r["text"]) for r in documents(spark).collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(documents(spark)).collect()}
    assert got == want


def test_pairs_among_many_texts_on_one_template(spark):
    rng, rows, want = random.Random(9), [], {}
    fresh = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n)]
    template = fresh(172)  # 168 of 200 shingles, so any two texts have a similarity of 168 / 232
    for k in range(1800):
        own = fresh(32)
        first = len(rows)
        rows.append((first, " ".join(template + own), "en", "s"))
        want[first] = first
        if k % 9 == 0:  # 172 / 228
            rows.append((first + 1, " ".join(template + own[:4] + fresh(28)), "en", "s"))
            want[first + 1] = first
    assert brute_components([r[:2] for r in rows[:40]]) == {i: (200, want[i]) for i in range(40)}
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(tables.frame(spark, rows)).collect()}
    assert got == want


def test_slices_of_large_buckets_leave_no_pair_out(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SKETCHES", 16)
    monkeypatch.setattr(neardup, "TEXTS", 8)
    rows = near_rows()
    want = brute_components([(r[0], r[1]) for r in rows])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(tables.frame(spark, rows)).collect()}
    assert got == want


def test_stars_find_long_paths_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (201, 200), (200, 201)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(60)}, 200: 200, 201: 200}


# -- 5, 8: rules and licences (their queries are compared with SQL) ---------------


def test_policies_and_ablation(spark):
    rows = [(0, "few words"), (1, tables.sentence(3)), (2, " ".join("#$ x" for _ in range(20))), (3, "# " * 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    entries = quality_rules.ledger(quality_rules.measure(docs))
    old = {r["doc_id"]: r["kept"] for r in quality_rules.apply_policy(entries, "v1").collect()}
    new = {r["doc_id"]: r["kept"] for r in quality_rules.apply_policy(entries, "v2").collect()}
    assert new[1] and old[1] and not new[0] and not new[2] and not new[3]
    effect = {r["rule"]: (r["failed"], r["only_this"]) for r in quality_rules.ablation(entries).collect()}
    assert effect["few_words"] == (1, 1) and set(effect) == set(quality_rules.POLICIES["v2"])
    none = quality_rules.ablation(entries.filter("doc_id < 0")).collect()
    assert len(none) == len(quality_rules.RULES) and all(r["failed"] == 0 for r in none)


def test_licences_are_found_in_any_spelling(spark):
    mit = dict(licenses.KNOWN)["MIT"]
    full = [t for n, t in licenses.KNOWN if n == "MIT" and len(t) > 500][0]
    rows = [
        (0, full),
        (1, "  " + full.upper().replace(",", " ,\n").replace("SOFTWARE", "Software")),
        (2, "MIT License\n\nCopyright (c) 2021 Some One\n\n" + full),
        (3, "text before\nlicensed under the apache licence, version 2.0\nand after"),
        (4, full + " and more"),
        (5, mit),
    ]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r["doc_id"]: (r["whole_license"], r["line_licenses"]) for r in found.collect()}
    assert [got[k][0] for k in range(6)] == ["MIT", "MIT", "MIT", None, None, "MIT"]
    assert got[3][1] == "Apache-2.0"


# -- 6, 10: classifiers -----------------------------------------------------------


@pytest.mark.parametrize("name, label, least", [("op6_toxicity", "toxic", 0.93), ("op10_quality_classifier", "quality", 0.93)])
def test_held_out_labels(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    assert found.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least


def test_folding_and_exceptions():
    assert toxicity.fold("ＩＤ1ОТ, id​iot $tupid!").split() == ["idiot", "idiot", "stupid"]
    assert toxicity.fold(None) == " " and toxicity.fold("") == " "
    matcher = toxicity.Matcher({" trash ": 2.0, " stup": 1.0}, (" trash can ",))
    assert matcher.find(toxicity.fold("trash can, trash! stupidly")) == [(2.0, "trash"), (1.0, "stup")]


def test_lexicon_finds_stems_and_words():
    counts = {"the": (400, 90), "the*": (400, 90), "idiot": (0, 60), "idio*": (0, 60), "idiot*": (0, 60)}
    for k in range(10):
        counts[f"zorgx{k}ab"] = (0, 6)
        counts[f"zorgx{k}*"] = (0, 6)
    counts |= {"zorg*": (0, 60), "zorgx*": (0, 60), "zorgy": (50, 0), "fine": (300, 50), "fine*": (300, 50)}
    weights, _ = toxicity._choose(counts, (500, 100))
    assert set(weights) == {" idiot ", " zorgx"}


def test_compression_prefers_the_likelier_dictionary():
    good = [tables.sentence(k, 80).encode() for k in range(60)]
    bad = [(" | ".join(tables.sentence(k, 40).split())).encode() for k in range(60)]
    measure = compression.Measure(compression.CompressionModel(compression._dictionary(good), compression._dictionary(bad), ()))
    sizes = np.array([measure.sizes(x.decode()) for x in (good[0], bad[0], b"")])
    d = compression.difference(sizes)
    assert d[0] > 0 > d[1] and d[2] == 0


# -- 7: mixing --------------------------------------------------------------------


def test_draws_follow_the_distribution(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'t' AS text", "if(id % 4 = 0, 'a', 'b') AS source")
    rates = spark.createDataFrame([("a", 2.5), ("b", 40.0), ("c", 1.0)], "source string, rate double")
    times = mixing.mix(docs, rates).groupBy("source", "doc_id").count()
    for source, rate, n in (("a", 2.5, 5000), ("b", 40.0, 15_000)):
        row = times.filter(F.col("source") == source).agg(F.sum("count").alias("s"), F.sum(F.col("count") ** 2).alias("q")).first()
        mean = row["s"] / n
        assert abs(mean - rate) < 5 * math.sqrt(rate / n)
        assert abs(row["q"] / n - mean**2 - rate) < 0.1 * rate
    steps = mixing.expected_steps(2.5)
    assert steps[-1] == pytest.approx(1)


def test_sources_reach_their_weights(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "'t' AS text", "if(id % 3 > 0, 'big', concat('s', id % 10)) AS source")
    mixed = mixing.mix(docs, mixing.source_rates(docs)).groupBy("source").count().collect()
    size = {r["source"]: r["count"] for r in mixed}
    given = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    whole = sum(math.sqrt(x) for x in given.values())
    for source, n in given.items():
        assert size[source] == pytest.approx(30_000 * math.sqrt(n) / whole, rel=0.1)


# -- 9: decontamination -----------------------------------------------------------


def edits(pattern: bytes, text: bytes) -> int:
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(last + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_regions_against_full_alignment():
    rng = random.Random(11)
    items = [(k, tables.sentence(500 + k, rng.choice([4, 12, 60]))) for k in range(25)]
    index = decontamination.build_index(items)
    texts = []
    for k, item in items * 3:
        own = list(item)
        for _ in range(rng.randint(0, max(1, len(own) // 12))):
            at = rng.randrange(len(own))
            own[at] = rng.choice(["", "q", own[at] + "z"])
        texts.append(tables.sentence(rng.randint(0, 10**6), 20) + " " + "".join(own) + " " + tables.sentence(rng.randint(0, 10**6), 15))
    texts += [tables.sentence(9000 + k, 80) for k in range(20)]
    found = decontamination._finder(index)(pa.array(texts))[0].to_pylist()
    fold = lambda t: re.sub(r"[^a-z0-9]+", " ", t.lower()).encode()
    for text, regions in zip(texts, found):
        body = fold(text)
        want = {
            int(index.item[s])
            for s, segment in enumerate(index.text)
            if edits(segment, body) <= index.edits[s]
        }
        assert {r["item_id"] for r in regions} == want


def test_excerpts_and_replaced_words_are_found():
    item = tables.sentence(77, 60)[:233].strip()
    short = next(t for t in (tables.sentence(k, 18) for k in range(999)) if 81 <= len(t) <= 100 and max(map(len, t.split())) == 7)
    found = decontamination._finder(decontamination.build_index([(0, item), (1, short)]))

    def replaced(text: str, *at: int) -> str:
        return " ".join("z" * len(w) if k in at else w for k, w in enumerate(text.split()))

    near = [k for k, w in enumerate(item.split()) if len(w) <= 7]
    cases = [(0, item[k : k + 120]) for k in range(len(item) - 119)]
    cases += [(0, item[k : k + 79]) for k in range(len(item) - 78)]
    cases += [(0, replaced(item, a, b)) for a in near for b in near]
    cases += [(1, replaced(short, k)) for k in range(18)]
    texts = [f"{tables.sentence(2000 + k, 20)} {text} {tables.sentence(5000 + k, 20)}" for k, (_, text) in enumerate(cases)]
    for (want, _), regions in zip(cases, found(pa.array(texts))[0].to_pylist()):
        assert {r["item_id"] for r in regions} == {want}


def test_benchmark_in_blocks_gives_the_same(spark):
    docs, benchmark = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = lambda n: sorted(
        (r["doc_id"], sorted(tuple(x) for x in r["regions"]))
        for r in decontamination.find(docs, benchmark, block_chars=n).collect()
    )
    assert rows(1000) == rows(8_000_000)
    whole = {
        d["doc_id"]
        for d in docs.collect()
        for b in benchmark.collect()
        if re.sub(r"\W+", " ", b["text"].lower()).strip() in re.sub(r"\W+", " ", d["text"].lower())
    }
    assert {i for i, regions in rows(8_000_000) if regions} == whole


def test_lost_array_files_are_noticed(spark):
    import glob
    import os

    docs = documents(spark)
    model = lm.learn(docs.select("text"))
    files = [f for f in glob.glob(f"{model.layout.folder}/*") if os.path.getsize(f)]
    assert {os.path.basename(f).split(".")[1] for f in files} >= {"key", "fact", "count"}
    for kind in ("words-*.fact", "pairs-*.key"):
        path = max(glob.glob(f"{model.layout.folder}/{kind}"), key=os.path.getsize)
        with open(path, "rb") as file:
            held = file.read()
        for left in (None, held[:-8]):
            os.remove(path) if left is None else open(path, "wb").write(left)
            with pytest.raises(Exception, match="No such file|bytes, not"):
                lm.score(docs, model).count()
            with open(path, "wb") as file:
                file.write(held)
    assert lm.score(docs, model).count() == docs.count()


def test_many_exceptions_take_no_time():
    import time

    matcher = toxicity.Matcher({" idiot ": 1.0, " trash ": 2.0}, (" trash can ", " can idiot "))
    folded = toxicity.fold("idiot trash can and trash " * 100_000)
    start = time.process_time()
    assert len(matcher.find(folded)) == 200_000
    assert time.process_time() - start < 5


def test_spellings_that_fold_alike():
    for spelling in ("idiot", "𝐢𝐝𝐢𝐨𝐭", "ⓘⓓⓘⓞⓣ", "ᵢdᵢₒt", "ɪᴅɪᴏᴛ", "ídïót", "1d10t", "ｉｄｉｏｔ"):
        assert toxicity.fold(spelling) == toxicity.fold("idiot"), spelling


def test_nothing_of_an_article_is_lost():
    first = tables.sentence(41, 40)
    both = f"{first}\n\n{first}"
    for empty in ("<svg viewBox='0' />", "<iframe src=x />", "<video src=x/>", "<svg><svg></svg>leak</svg>", "<object data=x/>"):
        assert htmltext.extract(f"<article><p>{first}</p>{empty}<p>{first}</p></article>") == both
    inner = f"<p class='search-result-text'>{first}</p><section id='related-work'><p>{first}</p></section>"
    inner += f"<div class='widget-code'>{first}</div>"
    signs = "<div class='share-bar'>x</div><div class='related posts'>x</div><div class='ad ad-300x250'>x</div><ul class=comments>x</ul>"
    assert htmltext.extract(f"<article>{inner}{signs}</article>") == f"{both}\n\n{first}"
    page = f"<body><nav><a>Home</a></nav><div><h1><a href=x>A title</a></h1><p>{first}</p><p><a href=y>The end of it</a></p></div><footer>x</footer>"
    assert htmltext.extract(page) == f"A title\n\n{first}\n\nThe end of it"


def test_deep_pages_take_no_time():
    import time

    start = time.process_time()
    htmltext.extract("<div>" * 100_000 + "</span>" * 100_000 + "text")
    htmltext.extract("<div><svg><iframe/>" * 30_000 + "text")
    assert time.process_time() - start < 8
