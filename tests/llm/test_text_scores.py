"""Toxicity, language, token counts and quality rules."""

import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest

from carelake.llm import language, quality, token_count, toxicity

MODEL = public.path("piece_bpe_32k.model")


# --- toxicity -------------------------------------------------------------------


def insults(seed, n):
    draw = random.Random(seed)
    plain = ["stone", "river", "ångström", "table", "wind", "paper", "lemon"]
    rows, labels = [], []
    for i in range(n):
        words = draw.choices(plain, k=draw.choice((8, 40, 200)))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(1, len(words) // 10)):
                words[draw.randrange(len(words))] = draw.choice(("grubwort", "grubling", "grubstuck"))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told_apart(spark, make):
    rows, labels = insults(1, 400)
    docs = make(rows + [(900, None), (901, ""), (None, "grubwort")], ["label", "score"])
    marks = spark.createDataFrame(labels + [(900, None), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(toxicity.labelled(docs, marks))
    scored = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for i, toxic in labels:
        assert scored[i].held_out == (toxicity.crc_remainder(i) == 0)
        assert scored[i].predicted == toxic and scored[i].predicted == int(scored[i].score >= 0.5)
    assert 0 <= scored[900].score == scored[901].score <= 1 and not scored[None].held_out
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in labels if not t} | {900, 901}


def test_held_out_labels_teach_nothing(spark, make):
    rows, labels = insults(2, 80)
    taught = [(i, t) for i, t in labels if toxicity.crc_remainder(i)]
    lied = taught + [(i, 1 - t) for i, t in labels if not toxicity.crc_remainder(i)]
    scores = [
        [r.score for r in toxicity.score(make(rows), toxicity.train(toxicity.labelled(make(rows), spark.createDataFrame(x, "doc_id long, toxic int")))).orderBy("doc_id").collect()]
        for x in (taught, lied)
    ]
    assert np.allclose(*scores, atol=1e-5)


@pytest.mark.parametrize("marks", [[], [(1, 0)], [(1, 1), (2, 1)]])
def test_one_label_or_none(spark, make, marks):
    docs = make([(1, "a"), (2, "b")])
    model = toxicity.train(toxicity.labelled(docs, spark.createDataFrame(marks, "doc_id long, toxic int")))
    n, toxic = len(marks), sum(t for _, t in marks)
    assert {round(r.score, 9) for r in toxicity.score(docs, model).collect()} == {round((toxic + 1) / (n + 2), 9)}
    assert toxicity.score(make([]), model).count() == 0


def test_long_texts_are_hashed_piece_by_piece(monkeypatch):
    text = " ".join(random.Random(3).choices(["ab", "cde", "fghij"], k=300))
    seen = np.zeros(toxicity.BUCKETS, dtype=bool)
    whole = Counter(np.concatenate(list(toxicity.hashed(text))).tolist())
    monkeypatch.setattr(toxicity, "PIECE", 64)
    assert Counter(np.concatenate(list(toxicity.hashed(text))).tolist()) == whole
    assert toxicity.distinct_buckets(text, seen).tolist() == sorted(whole) and not seen.any()


# --- token counts ---------------------------------------------------------------


def test_spliced_counts_match_whole_texts():
    model, provable = token_count.load_processor(MODEL)
    assert provable
    draw = random.Random(1)
    parts = ["a", "the ", " ", "  ", "\n", "é", "日本", "x" * 30, "\t", "▁", "<s>", "</s>", "😀", "ou. ", " of", "0", "!!", "<unk>", "\r\n", "\x00"]
    for _ in range(800):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(300)))
        chunk, overlap = draw.choice([(40, 5), (20, 3), (100, 30), (64, 8)])
        assert token_count.splice_count(model, text, chunk, overlap) == len(model.encode(text))


def test_overlaps_widen_where_no_boundary_is_stable():
    model, _ = token_count.load_processor(MODEL)
    for text in ("x" * 5000, "日" * 3000, " " * 4000, ("y" * 900 + " ") * 5):
        assert token_count.splice_count(model, text, 256, 16) == len(model.encode(text))


def test_counts_of_rows(make):
    model, _ = token_count.load_processor(MODEL)
    rows = [(1, None), (2, ""), (3, "Ünï <s> text"), (3, "Ünï <s> text"), (None, "x"), (5, "word and more " * 40_000)]
    got = token_count.count_tokens(make(rows, ["n_tokens"]), MODEL).collect()
    want = [(str(i), len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted(want)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_count.count_tokens(make([]), MODEL).count() == 0


# --- quality rules --------------------------------------------------------------


def brute_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_figures_match_brute_force(make):
    draw = random.Random(6)
    rows = [
        (i, "".join(draw.choice(["a", "b c", " ", "\n", "é#", "$ ", "日本 ", "\x0b", "x y z ", "\xa0"]) for _ in range(draw.randrange(200))))
        for i in range(120)
    ]
    rows += [(200, None), (201, ""), (None, "a b c a b c"), (202, "q r s t " * 20_000)]
    rows += [rows[3]]
    got = quality.judge(make(rows, ["host", "words"])).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r.doc_id), *(r[n] for n in names)) for r in got) == sorted((str(i), *brute_figures(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_hosts_are_judged_by_shrunk_rates(make):
    draw = random.Random(8)
    good = lambda: " ".join(f"w{draw.randrange(10**6)}" for _ in range(60))
    rows = [(i, good() if i % 10 else "short", "en", "fine") for i in range(100)]
    rows += [(200 + i, good() if i % 10 == 0 else "short", "en", "bad") for i in range(100)]
    rows += [(400, "short", "en", "small"), (401, good(), "en", "small"), (402, good(), "en", None)]
    got = {r.doc_id: r for r in quality.judge(make(rows)).collect()}
    assert not any(got[200 + i].kept for i in range(100))
    assert got[200].host_rate > 0.5 and not got[200].base_failed
    assert all(got[i].kept == (i % 10 != 0) for i in range(100))
    assert got[401].kept and got[402].kept and got[402].host_rate is None
    assert quality.judge(make([])).count() == 0


# --- language -------------------------------------------------------------------

SOUNDS = {"aa": ["lo", "ma", "ri", "no"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["oux", "eau", "tre", "que"]}


def prose(name, draw, n):
    return " ".join("".join(draw.choices(SOUNDS[name], k=3)) for _ in range(n))


def test_pages_in_three_languages(spark, make):
    draw = random.Random(1)
    docs = make([(i, prose(n, draw, 60), n, "s") for i, n in enumerate(list(SOUNDS) * 20)] + [(99, None, "aa", "s"), (98, "x", None, "s")])
    rows, truth = [], {}
    for i in range(90):
        name = list(SOUNDS)[i % 3]
        truth[i] = name
        text = prose(name, draw, draw.choice((3, 40)))
        rows.append((i, f"http://h{i % 3}.site.{name}/p{i}", f'<html lang="{name.upper()}-x"><script>{prose("aa", draw, 30)}</script><p>{text}</p>'))
    rows += [(100, "http://h1.site.bb/x", None), (101, None, None), (102, "http://10.0.0.1/", ""), (5, *rows[5][1:])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS own_0")
    got = language.identify(pages, docs).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert all(by_id[i].language == n and by_id[i].declared == n for i, n in truth.items())
    assert by_id[100].language == "bb"  # its host and suffix speak for it
    assert by_id[101].language in SOUNDS and 0 < by_id[101].confidence <= 1
    assert language.identify(pages.limit(0), docs).count() == 0
    assert {r.language for r in language.identify(pages, make([])).collect()} == {None}


def test_text_of_a_page():
    page = "<html LANG='de-AT'><!-- <b>x</b> --><style>p{}</style><p>a&amp;b<br>c</p><script>1<2</script>"
    assert language.visible_text(page).split() == ["a&b", "c"]
    assert language.declared_language(page) == "de" and language.declared_language("<p>") is None


OLD = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)


def test_pages_are_read_as_by_the_plain_pattern():
    draw = random.Random(9)
    parts = ["<!--", "-->", "<script", "<style>", "</script >", "</STYLE>", "</script", "<", ">", "a", " ", "<p>", "<!-", "->", "\n", "<scripts>"]
    for _ in range(4000):
        page = "".join(draw.choices(parts, k=draw.randrange(14)))
        assert language.visible_text(page) == OLD.sub(" ", page)
    roots = ["<html", " lang", "=", "'", '"', " ", "de", "EN-x", ">", "x", "\n"]
    plain = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]{2,8})", re.I)
    for _ in range(20_000):
        page = "".join(draw.choices(roots, k=draw.randrange(12)))
        found = plain.search(page)
        assert language.declared_language(page) == (found and found[1].lower())


@pytest.mark.parametrize("part", ["<script>", "<!--", "<html ", "<", "<style", "</script ", "<html lang=", "lang ", "<html lang=" + " " * 50])
def test_reading_a_page_takes_time_by_its_length(part):
    page = part * (1_000_000 // len(part))
    start = time.process_time()
    language.visible_text(page)
    language.declared_language(page)
    language.declared_language("<html " + page)
    assert time.process_time() - start < 3


def test_posteriors_match_plain_sums(spark, make):
    """Every step again with dictionaries, for a table with all kinds of evidence."""
    draw = random.Random(4)
    docs = [(i, prose(n, draw, 20), n, "s") for i, n in enumerate(list(SOUNDS) * 4)]
    rows = []
    for i in range(60):
        name = draw.choice(list(SOUNDS))
        host = draw.choice(["a.x.aa", "b.x.aa", "www.y.bb", "10.0.0.1", "[::1]", "z.cc"])
        lang = draw.choice(["", f' lang="{draw.choice(list(SOUNDS))}"'])
        rows.append((i, draw.choice([f"http://{host}/p", None]), f"<html{lang}><p>{prose(name, draw, draw.randrange(4))}</p>"))
    rows += [(70, None, None), rows[3]]

    languages = sorted(SOUNDS)
    counts = {n: Counter() for n in languages}
    for _, text, name, _ in docs:
        for some in language.hashed(text, language.LENGTHS, language.BITS):
            counts[name].update(some.tolist())
    size = {n: sum(counts[n].values()) + language.SMOOTHING * language.BUCKETS for n in languages}

    def shares(page):
        text = language.visible_text(page)
        if not text.strip():
            return [1 / 3] * 3
        seen = [b for some in language.hashed(text, language.LENGTHS, language.BITS) for b in some.tolist()]
        logs = [sum(language.TEMPER * np.log((counts[n][b] + language.SMOOTHING) / size[n]) for b in seen) for n in languages]
        raised = [np.exp(max(x - max(logs), -language.MOST)) for x in logs]
        return [x / sum(raised) for x in raised]

    pages = []
    for page_id, url, page in rows:
        host = re.match("http://([^/]*)", url)[1] if url else None
        numeric = host and (host[0] == "[" or re.fullmatch("[0-9.]+", host))
        domain = host if numeric or not host else ".".join(host.split(".")[-2:])
        suffix = None if numeric or not host else host.split(".")[-1]
        pages.append((page_id, shares(page), {"declared": language.declared_language(page), "suffix": suffix, "domain": domain, "host": host}))
    total = [sum(p[1][i] for p in pages) + 1e-9 for i in range(3)]
    overall = [x / sum(total) for x in total]

    def others(page, key, i):
        value = page[2][key]
        return 0.0 if value is None else max(0.0, sum(p[1][i] for p in pages if p[2][key] == value) - page[1][i])

    def number(page, key):
        return sum(p[2][key] == page[2][key] for p in pages) - 1 if page[2][key] is not None else 0

    want = {}
    for page in pages:
        logs = []
        for i in range(3):
            domain = (others(page, "domain", i) + 5 * overall[i]) / (number(page, "domain") + 5)
            prior = (others(page, "host", i) + 5 * domain) / (number(page, "host") + 5)
            log = np.log(page[1][i]) + np.log(max(language.FLOOR, prior))
            for key in ("declared", "suffix"):
                if page[2][key] is not None:
                    share = (others(page, key, i) + 2 * overall[i]) / (number(page, key) + 2)
                    log += np.log(max(language.FLOOR, share)) - np.log(max(language.FLOOR, overall[i]))
            logs.append(log)
        best = int(np.argmax(logs))
        want[page[0]] = (languages[best], 1 / sum(np.exp(x - max(logs)) for x in logs))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = language.identify(frame, make(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.language == want[r.page_id][0]
        assert r.confidence == pytest.approx(want[r.page_id][1], abs=2e-6)


def test_too_many_languages_are_refused(spark, make):
    docs = make([(i, "x", f"l{i}", "s") for i in range(language.MOST_LANGUAGES + 1)])
    with pytest.raises(ValueError, match="languages"):
        language.train_languages(docs)
