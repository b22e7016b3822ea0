"""Quality rules, URL filter and the two classifiers."""

import random
import re
import zlib
from collections import Counter

import pytest

from adlake.llm import quality_pu, quality_rules, toxicity, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside),
    )


def odd_texts():
    draw = random.Random(3)
    vocabulary = ["the", "of", "and", "größe", "naïve", "x#y", "a|b", "!!", "…", "日本語"]
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "\n\n", "a\u00a0b c", "w " * 5000, "same line here\n" * 40]
    texts += ["\n".join(" ".join(draw.choices(vocabulary, k=draw.randint(0, 30))) for _ in range(4)) for _ in range(40)]
    texts += [" ".join(f"w{i % 9}" for i in range(50)), " ".join(f"w{i}" for i in range(20000))]
    return texts


def test_rule_counts_match_brute_force(docs):
    texts = odd_texts()
    got = {r.doc_id: r for r in quality_rules.judge(docs(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(text), i
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_rules_keep_rows_and_columns(docs):
    good = "The house of the river and the wood is to be seen with ease, for it was made in that year by hand."
    table = docs([(1, good), (1, good), (2, "# # # " + good.replace(" ", " ## ")), (None, good), (3, None)])
    kept = quality_rules.keep(table)
    assert kept.columns == table.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "1", "None"]
    assert quality_rules.keep(table.limit(0)).count() == 0


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [h + p for h, p, _ in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


def test_urls_match_brute_force(spark):
    urls = [
        None, "", "no scheme", "http://", "http://A.Example.ORG/es/1?q", "https://example.org/en/19#t", "x://org/", "x://org",
        "http://notorg/", "http://a.com/fr/://b.net/", "http://a.com/de/x\ny?z", "HTTP://ÄB.Com/fr/", "http://h.net?a=/de/",
        "http://a.com#/fr/", "http://cheap-pills.example.net/en/1", "http://quiet-river.example.net/en/1", "http://org/" + "p" * 9000,
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(3, urls[3], "h")], "page_id long, url string, host string")
    got = url_filter.judge(pages).collect()
    assert len(got) == len(urls) + 1
    verdicts = {h + p: v for h, p, v in url_filter.RULES}
    for r in got:
        host, path, rule = brute_url(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if rule:
            assert r.verdict == verdicts[rule]
    by_id = {r.page_id: r.verdict for r in got}
    assert (by_id[14], by_id[15], by_id[0]) == ("block", "allow", "allow")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_model_takes_other_labels(spark):
    labelled = spark.createDataFrame([("http://aaa.net/", 1), ("http://bbb.net/", 0)], "url string, label int")
    pages = spark.createDataFrame([(1, "http://aaaa.net/"), (2, "http://bbbb.net/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, labelled, rules=()).collect()}
    assert got == {1: "block", 2: "allow"}


@pytest.fixture(scope="module")
def corpus(spark):
    """Words of invented syllables; bad ones are misspelt in many ways, poor texts repeat or shout."""
    draw = random.Random(7)
    syllables = ["lo", "ra", "mi", "ten", "sol", "ver", "pa", "qui", "est", "on", "dar", "bel"]
    rows, labels = [], []
    for i in range(700):
        words = ["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(draw.randint(20, 150))]
        toxic, poor = i % 4 == 0, i % 5 == 0
        if toxic:
            for _ in range(3):
                words[draw.randrange(len(words))] = "zgrunk" + "".join(draw.choices(syllables, k=1))
        text = " ".join(words) + "."
        if poor:
            text = text.upper().replace(" ", "!! ") if i % 2 else " ".join(w + "###" for w in words)
        rows.append((i, text))
        labels.append((i, int(not poor), int(toxic)))
    from adlake.llm.common import start

    made = start(spark).createDataFrame(labels, "doc_id long, quality int, toxic int")
    return start(spark).createDataFrame([*rows, (900, None), (901, ""), (None, "lo ra")], "doc_id long, text string"), made, labels


@pytest.mark.parametrize("module, label, folds, held, least", [(toxicity, 2, 3, 1, 0.9), (quality_pu, 1, 5, 0, 0.9)])
def test_classifiers_on_held_out_rows(corpus, module, label, folds, held, least):
    docs, labels, truth = corpus
    got = module.classify(docs, labels).collect()
    assert len(got) == 703 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    rows = [by_id[t[0]] for t in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    right = [r.predicted == t[label] for r, t in zip(rows, truth, strict=True) if r.held_out]
    assert sum(right) >= least * len(right)


@pytest.mark.parametrize("module", [toxicity, quality_pu])
def test_classifiers_without_labels_or_rows(corpus, module):
    docs, labels, _ = corpus
    assert {r.score for r in module.classify(docs, labels.limit(0)).collect()} == {0.0}
    assert module.classify(docs.limit(0), labels).count() == 0
