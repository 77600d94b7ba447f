"""Source divergence, page extraction and periodic runs against brute force, with every awkward row."""

from __future__ import annotations

import hashlib
import html
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from terrafold.llm import catalog, divergence, pages, runs
from terrafold.llm.divergence import DivergenceSettings
from tests.llm.support import awkward_rows, collected, frame

# ---------------------------------------------------------------- divergence


def divergence_by_counting(rows: list[tuple], least: int = 3, ranks: int = 200) -> list[tuple]:
    scale, count, held, groups = 10**9, Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        count.update((lang, source, t) for t in terms)
        held.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in held.items() if x == lang and n >= least]
        sources = [s for x, s in groups if x == lang]
        total = {s: sum(count[lang, s, t] for t in kept) for s in sources}
        p = {s: {t: 1 + scale * (count[lang, s, t] + 1) // (total[s] + len(kept)) for t in kept} for s in sources}
        every, n = sum(total.values()), {t: sum(count[lang, s, t] for s in sources) for t in kept}
        q = {t: 1 + scale * (n[t] + 1) // (every + len(kept)) for t in kept}
        for s in sources:
            parts = {
                "pair": [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s],
                "term": [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[lang, s, t] and p[s][t] > q[t]],
            }
            for part, items in parts.items():
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, *x, k + 1) for k, x in enumerate(ranked) if part == "pair" or k < ranks]
    return sorted(out)


def _sourced() -> list[tuple]:
    rng, rows = random.Random(5), []
    for k in range(140):
        words = [f"{rng.choice('abcdefgh')}{rng.choice('xyzäß')}{'oo' * rng.randint(0, 2)}" for _ in range(rng.randint(0, 60))]
        source = "hot" if k % 3 == 0 else f"s{rng.randint(0, 5)}"
        rows.append((rng.choice(["en", "de"]), source, " ".join(w.upper() if rng.random() < 0.2 else w for w in words)))
    rows += [(None, None, None), ("xx", "a", None), ("xx", "b", "!! 12"), ("en", None, "The thE É é É"), ("yy", "only", "a b c")]
    rows += [("yy", "only", "a b c")] * 3 + [("zz", "a:1", "tie " * 4), ("zz", "b", "tie tie é z Z"), ("zz", "b", "é tie z"), ("zz", "c", "z é")]
    rows.append(("en", "long", "word " * 60_000 + "axoo " * 5))
    return rows


@pytest.mark.parametrize("settings", [
    DivergenceSettings(), DivergenceSettings(digest_bits=6, ranks=5), DivergenceSettings(flush=40, ranks=3),
    DivergenceSettings(digest_bits=9, documents=1, flush=100),
])
def test_divergence_equals_counting(spark, settings):
    rows = _sourced()
    docs = frame(spark, rows, "lang string, source string, text string").repartition(5)
    got = divergence.divergence(docs, settings)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == divergence_by_counting(rows, settings.documents, settings.ranks)


def test_terms_of_one_digest_are_told_apart(spark):
    """Eight digests for dozens of terms: nearly all are shared, and rare terms must not be kept for their namesakes."""
    rows = _sourced()
    docs = frame(spark, rows, "lang string, source string, text string").select("lang", "source", "text").na.fill("")
    counts, _ = divergence.kept_counts(docs, DivergenceSettings(digest_bits=3))
    split = counts.filter("part > 0").toPandas()
    assert len(split) and split.text.notna().all()
    assert split.groupby("digest").part.max().max() > 5


def test_divergence_of_an_empty_table(spark):
    assert divergence.divergence(frame(spark, [], "lang string, source string, text string")).count() == 0


def test_divergence_query_equals_its_sql(spark, folder):
    got = sorted(map(tuple, catalog.op11_source_divergence(spark, folder).collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    assert got == sorted(con.execute(catalog.ORACLES["op11_source_divergence"]).fetchall())


# ---------------------------------------------------------------- pages

HEAD = "<!DOCTYPE html><html><head><title>t &amp; u</title><style>p{a:b}</style><script>var t='</p><article>x'</script></head><body>"


def test_lines_of_a_page():
    page = HEAD + (
        "<header><h1>Site</h1></header><nav><ul><li><a href='/a'>Menu</a></li></ul></nav><div class='ad big'>Buy</div>"
        "<main id=content><article class='post header'><header><h1>Title &eacute;&#x41;</h1></header><p>One <b>two</b>\n\t three<br>four"
        "<p>Five &lt;six&gt; &amp;amp; a<3 <!-- no <p> --> b<ul><li>x<li>y</ul><aside>Side</aside><form><p>Name<input></form>"
        "<section id=comments><article>Reader</article></section><pre> a\n b </pre><table><tr><td>c<td>d</table>end</article></main>"
        "<div role='contentinfo'>Imprint</div><p class=\"cookie-notice\">We use</p><footer>&copy; f</footer></body>"
    )
    kept = [t for t, place in pages.page_lines(page) if place == pages.ARTICLE]
    assert kept == ["Title éA", "One two three four", "Five <six> &amp; a<3 b", "x", "y", "a b", "c", "d", "end"]
    assert {"Menu", "Buy", "Site", "Side", "Reader", "Imprint", "We use", "© f"} <= {t for t, p in pages.page_lines(page) if p == pages.OTHER}


@pytest.mark.parametrize("page", ["", "<", "<p", "text only", "<!-- never ends", "<script>x", "</p></div>", "<a title='x>y'>z", '<a b=">', "<p>" * 3000, "a<b & c &amp &bogus;"])
def test_broken_pages_do_not_raise(page):
    assert all(t for t, _ in pages.page_lines(page))


def _common_by_table(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
    return best[-1, -1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 18))] for _ in range(2))
        for found in (pages.common_lines(a, b), pages._align(a, b, 20)):
            assert all(a[i] == b[j] for i, j in found) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))
            assert len(found) == _common_by_table(a, b)


def extracted(rows: list[tuple]) -> dict[int, tuple[str, int]]:
    """Pages by nearest path, differenced pair by pair in plain Python."""
    read = {(u, h or ""): pages.page_lines(h or "") for _, u, h in rows}
    key = lambda u, h: hashlib.sha256("\n".join(x for x in (u, h) if x is not None).encode()).digest()
    sited = []
    for u, h in read:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        if m and m[1]:
            sited.append((re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2], key(u, h), (u, h)))
    gone = {k: set() for k in read}
    for one, two in zip(sorted(sited), sorted(sited)[1:]):
        a, b = read[one[3]], read[two[3]]
        common = pages.common_lines([t for t, _ in a], [t for t, _ in b])
        total = min(sum(len(t) for t, p in x if p != pages.OTHER) for x in (a, b))
        if one[0] == two[0] and 2 * sum(len(a[i][0]) for i, _ in common if a[i][1] != pages.OTHER) <= total:
            gone[one[3]] |= {i for i, _ in common if a[i][1] == pages.OPEN}
            gone[two[3]] |= {j for _, j in common if b[j][1] == pages.OPEN}
    out = {}
    for i, u, h in rows:
        lines, drop = read[u, h or ""], gone[u, h or ""]
        use = pages.ARTICLE if any(p == pages.ARTICLE for _, p in lines) else pages.OPEN
        out[i] = ("\n".join(t for k, (t, p) in enumerate(lines) if p == use and k not in drop), len(drop))
    return out


def _sites() -> list[tuple]:
    rng, rows = random.Random(8), []
    for k in range(90):
        host = "hot.example.com" if k % 3 else f"WWW{k % 5}.example.org"
        section = rng.randint(0, 3)
        body = "".join(f"<p>{rng.choice('abc')}{rng.randint(0, 10**6)} own text of page {k} that nobody repeats</p>" for _ in range(rng.randint(0, 5)))
        rows.append((k, f"https://{host}/s{section}/{k:03d}?q={k}", f"<div>Site of {section}</div><p>Latest</p>{body}<p>All rights reserved {section}</p>"))
    copy = "<div>Site of 1</div>" + "<p>A long passage that copies share from end to end</p>" * 8
    rows += [(200 + k, f"http://copies.example.com/a/{k}", copy + (f"<p>{k}</p>" if k % 2 else "")) for k in range(6)]
    rows += [(300, None, "<p>no url</p>"), (301, "no scheme", "<p>x</p>"), (302, "http://e.example/", None), (303, "http://e.example/", ""),
             (304, "http://e.example/1", "<article><p>Latest</p></article><p>Latest</p>"), (305, "http://e.example/2", "<article><p>Latest</p></article><p>Latest</p>"),
             (306, "http://e.example/3", "".join(f"<p>line {k}</p>" for k in range(6000)))]
    return rows + [(400, *rows[0][1:]), (401, *rows[0][1:])]


def test_pages_equal_plain_differencing(spark):
    rows = _sites()
    docs = frame(spark, rows, "page_id long, url string, html string").repartition(7)
    got = collected(pages.extract_pages(docs))
    want = extracted(rows)
    assert len(got) == len(rows)
    for r in got.itertuples():
        assert (r.text, r.n_shared) == want[r.page_id] and r.n_chars == len(r.text), r
    by_id = got.set_index("page_id")
    assert (by_id.n_shared > 0).sum() > 60  # templates without marks are found by differencing alone
    assert "Latest" not in by_id.text[5] and "own text" in " ".join(by_id.text[:90])
    assert "A long passage" in by_id.text[200] and by_id.text[304] == "Latest"
    assert by_id.text[400] == by_id.text[0]


def test_every_given_page_gives_its_article(spark, folder):
    got = collected(catalog.op12_html_extraction(spark, folder)).set_index("page_id")
    source = spark.read.parquet(f"{folder}/pages.parquet").collect()
    for r in source:
        body = re.search("(?s)<article>(.*)</article>", r.html)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split("<[^>]*>", body)]
        assert got.text[r.page_id] == "\n".join(x for x in blocks if x)
    assert got.index.is_unique and len(got) == len(source)


def test_pages_of_an_empty_table(spark):
    assert pages.extract_pages(frame(spark, [], "page_id long, url string, html string")).count() == 0


# ---------------------------------------------------------------- runs


def runs_by_periods(words: list[str], least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal stretch with a smallest period, period by period."""
    best: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and j > i:
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], found: list[tuple[int, int, int]]) -> str:
    gone = {k for a, n, q in found for k in range(a + q, a + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def _periodic_texts() -> list[str | None]:
    rng, out = random.Random(11), [None, "", " \t\n ", "one", "a " * 11, "a " * 12, "ab ab ab\nab\x0bab ab"]
    for _ in range(60):
        n, letters = rng.randint(1, 90), rng.randint(1, 4)
        out.append(" ".join(rng.choice("pqrs"[:letters]) for _ in range(n)))
    fib = ["a", "b"]
    for _ in range(10):
        fib.append(fib[-1] + " " + fib[-2])
    out.append(fib[-1])
    for p in (1, 2, 3, 4, 5, 7, 30, 400):
        out.append(" ".join(f"w{k % p}" for k in range(3 * p + 11)) + " é x y  \r\n" + "日本 " * 20)
    line = "the same line comes again and again in this text"
    out.append(f"head {line} {line} {line} the same line comes tail")
    out.append(" ".join(["word"] * 4000))
    out.append(" ".join(str(k * k % 7919) for k in range(40_000)))
    return out


def test_runs_equal_brute_force(spark):
    texts = _periodic_texts()
    rows = list(enumerate(texts)) + [(None, texts[8]), (8, texts[8])]
    got = runs.find_runs(frame(spark, rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall("[^\x20\x09-\x0d]+", texts[8 if r.doc_id is None else r.doc_id] or "")
        want = runs_by_periods(words) if len(words) < 10_000 else [(0, 40_000, 7919)]  # k * k mod 7919
        assert [tuple(x) for x in r.runs] == want
        assert r.n_words == len(words) and r.collapsed == collapsed(words, want)


def test_runs_do_not_depend_on_neighbours(monkeypatch, spark):
    """The same rows, one by one and in one slice."""
    words = [np.array(w) for w in ([0, 1] * 9, [0] * 20, [2, 0, 1, 3] * 5)]
    heads = np.cumsum([0, *map(len, words)])
    row, *rest = runs.slice_runs(np.concatenate(words), heads, 12)
    for k, w in enumerate(words):
        alone = runs.slice_runs(w, np.array([0, len(w)]), 12)
        assert [c[row == k].tolist() for c in rest] == [c.tolist() for c in alone[1:]]


def test_equal_hashes_are_not_equal_words():
    data = np.frombuffer(b"aa bb aa", np.uint8)
    got = runs.word_numbers(data, np.array([0, 3, 6]), np.array([2, 5, 8]), lambda d, a, b: np.zeros(len(a), np.uint64))
    assert got.tolist() == [0, 1, 0]


def test_run_query_equals_its_contract(spark, folder):
    got = collected(catalog.op13_periodic_runs(spark, folder)).set_index("doc_id")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    tails = 0
    for r in docs:
        words = re.findall("[^\x20\x09-\x0d]+", r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            tails += 1
        if n > 3000:
            continue  # quadratic here
        found, row = runs_by_periods(words), got.loc[r.doc_id]
        assert row.n_runs == len(found)
        if found:
            s, m, q = min(found, key=lambda x: (-x[1], x[0], x[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, m, q, 1000 * m // q)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
    assert tails > 5


def test_runs_of_awkward_rows(spark):
    got = runs.find_runs(frame(spark)).collect()
    assert len(got) == len(awkward_rows())
    assert runs.find_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        runs.RunSettings(least=5)


def test_planted_tails_of_rows_without_id():
    first, period = catalog.planted_tails([None, 5], np.array([7, 0]))
    assert first.tolist() == [0, 0] and period.tolist() == [0, 0]
