import hashlib
import re

import numpy as np
import pandas as pd
import pytest

from terrafold.llm import chat, exact, urls
from terrafold.llm.catalog import URL_RULES

from .support import awkward_rows, collected, frame


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def check_groups(rows, got):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(normal(text), []).append(i)
    assert len(got) == len(rows)
    for text, ids in groups.items():
        own = got[got.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        named = [i for i in ids if i is not None]
        assert sorted(own.doc_id.dropna()) == sorted(named)
        assert set(own.group_size) == {len(ids)}
        assert own.kept.sum() == 1
        if named:
            assert set(own.keep_id) == {min(named)}


@pytest.mark.parametrize("digits", [(64, 16), (1, 1), (3, 2)])
def test_exact_groups(spark, digits):
    rows = [r for r in awkward_rows() if len(r[1] or "") < 500] if digits[0] < 64 else awkward_rows()
    if digits[1] == 1:
        rows = [(i, t) for i, t in enumerate(["", "a", "ab", "ab", "abc", "ac", None, "a b", "a  b", "abcd", "abcd"])]
        df = frame(spark, rows, "doc_id long, text string")
    else:
        df = frame(spark, rows)
    check_groups(rows, collected(exact.exact_groups(df, first_digit=digits[0], growth=digits[1])))


def test_texts_that_end_at_a_digit_differ_from_longer_ones(spark):
    rows = [(1, "a" * 64), (2, "a" * 65), (3, "a" * 64), (4, "a" * 1088), (5, "a" * 1089), (6, "a" * 1088)]
    check_groups(rows, collected(exact.exact_groups(frame(spark, rows, "doc_id long, text string"))))


def test_exact_on_an_empty_table(spark):
    df = frame(spark, [])
    assert exact.exact_groups(df).count() == 0
    assert exact.drop_exact_copies(df).columns == df.columns


def test_dropping_copies_keeps_all_columns(spark):
    df = frame(spark)
    left = exact.drop_exact_copies(df)
    assert left.columns == df.columns
    got = collected(left)
    assert len(got) == len({normal(t) for _, t, _ in awkward_rows()})
    assert sorted(got.doc_id.dropna()) == [1, 4, 5, 7, 8, 10, 11, 12, 13, 14, 14, 15]


CHATS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "<|im_end|> \\ <|im_start|>"),
    (2, 1, "assistant", "second"), (2, 0, "user", None), (3, 0, "assistant", "too early"), (3, 1, None, "who?"),
    (4, 0, "user", "</s>[INST]\\[INST]\\\\ <<SYS>>"), (4, 0, "user", "tie"), (4, None, "<|im_sep|>", ""),
    (5, 0, "user", "a<"), (5, 1, "assistant", "|im_end|> é 🙂"), (None, 0, "user", "nameless"), (6, 0, "user", "x" * 50_000),
]


def check_chats(rows, template, back):
    turns = {}
    for c, t, r, x in rows:
        turns.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert len(back) == len(turns)
    for row in back.itertuples():
        own = sorted(turns[None if pd.isna(row.conv_id) else int(row.conv_id)])
        assert [(t["role"], t["text"]) for t in row.turns] == [x[2:] for x in own]
        assert row.loss_text == "".join(x[3] for x in own if x[2] in template.loss_roles)
        for control in template.controls():
            marks = {template.turn_open, template.role_close, template.turn_close}
            assert row.formatted.count(control) == (len(own) if control in marks else 0)


@pytest.mark.parametrize("template", [
    chat.ChatTemplate(), chat.ChatTemplate("[[", "]]", "~~", ("<|", "\x00\x01"), ("user", "assistant")),
])
def test_chat_round_trip(spark, template):
    df = frame(spark, CHATS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df, template)
    check_chats(CHATS, template, collected(chat.read_back(formatted, template)))
    for row in formatted.collect():
        assert "".join(row.formatted[s.start : s.start + s.length] for s in row.segments) == row.formatted


def test_turn_order_machine(spark):
    rows = collected(chat.format_conversations(frame(spark, CHATS, "conv_id long, turn long, role string, text string")))
    rows = rows.set_index(rows.conv_id.fillna(-1).astype(int))
    assert rows.valid.to_dict() == {1: True, 2: True, 3: False, 4: False, 5: True, 6: False, -1: False}
    assert rows.first_bad[3] == 0 and rows.first_bad[4] == 0 and pd.isna(rows.first_bad[6])


def test_chat_needs_safe_control_strings():
    with pytest.raises(ValueError):
        chat.ChatTemplate(guarded=("x",)).controls()


def test_chat_on_an_empty_table(spark):
    df = frame(spark, [], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).count() == 0


URLS = [
    (1, "http://a.example.net/en/1?x#y"), (2, "HTTPS://B.Example.NET/de/"), (3, "http://example.com/de/x"), (4, "x.org/fr/"),
    (5, None), (6, ""), (7, "http://net"), (8, "http://net/"), (9, "ftp://ÄB.org/fr/ü?q"), (10, "://org#/fr/"),
    (11, "http://anexample.net/en/"), (12, "http://a?b/en/"), (13, "http://org/fr"), (14, "x\ny://Net/a\nb"), (None, "http://z.org/fr/"),
    (1, "http://a.example.net/en/1?x#y"), (15, "http://q.example.com/it/" + "z" * 5000),
]


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def test_hosts_paths_and_rules(spark):
    got = collected(urls.filter_urls(frame(spark, URLS, "page_id long, url string"), URL_RULES))
    assert len(got) == len(URLS)
    want = sorted(repr((p, *judge(u)[:3])) for p, u in URLS)
    rows = [(None if pd.isna(r.page_id) else int(r.page_id), r.host, r.path, r.rule) for r in got.itertuples()]
    assert sorted(map(repr, rows)) == want
    for r in got.itertuples():
        if r.rule is not None:
            assert r.verdict == {h + p: v for v, h, p in URL_RULES}[r.rule]
        assert r.verdict in ("allow", "block") and np.isfinite(r.llr)


def test_model_equals_plain_counting(spark):
    settings = urls.UrlModelSettings(orders=2, table_bits=16, held_out=10**6)
    train = [("abab", False), ("abb", False), ("xyxy", True), ("xyy", True)]
    model = urls.fit(frame(spark, train, "url string, bad boolean"), settings)

    def chance(text, kind):
        seen = [t for t, bad in train if bad == kind]
        total = 0.0
        for i, c in enumerate(text):
            p = 1 / 256
            for k in range(settings.orders + 1):
                key = ("^" * k + text[:i])[-k:] if k else ""
                padded = ["^" * k + t for t in seen]
                spots = [(t, j) for t in padded for j in range(k, len(t)) if t[j - k : j] == key]
                p = (sum(t[j] == c for t, j in spots) + settings.weight * p) / (len(spots) + settings.weight)
            total += np.log(p)
        return total / max(1, len(text))

    texts = ["abab", "xyb", "q", ""]
    got = urls.scored_urls(frame(spark, [(t,) for t in texts], "url string", clash=False), model, settings).collect()
    for row in got:
        assert row.llr == pytest.approx(chance(row.url, True) - chance(row.url, False), abs=1e-5)


def test_unruled_urls_follow_the_models(spark):
    rng = np.random.default_rng(3)
    name = lambda: "".join(rng.choice(list("abcdef"), 6))
    rows = [(i, f"http://{name()}.example.net/en/good-{name()}") for i in range(150)]
    rows += [(i, f"http://{name()}.other.net/casino-{name()}") for i in range(150, 300)]
    asked = [(1000 + i, f"http://{name()}.example.io/en/good-{name()}") for i in range(20)]
    asked += [(2000 + i, f"http://{name()}.example.io/casino-{name()}") for i in range(20)]
    got = collected(urls.filter_urls(frame(spark, rows + asked, "page_id long, url string"), URL_RULES)).set_index("page_id")
    assert (got.verdict[[1000 + i for i in range(20)]] == "allow").mean() >= 0.9
    assert (got.verdict[[2000 + i for i in range(20)]] == "block").mean() >= 0.9


def test_urls_without_labels_or_rows(spark):
    got = collected(urls.filter_urls(frame(spark, [(1, "http://x.io/"), (2, None)], "page_id long, url string"), URL_RULES))
    assert list(got.verdict) == ["allow", "allow"]
    assert urls.filter_urls(frame(spark, [], "page_id long, url string"), []).count() == 0


def test_sql_counterparts_on_the_tables(spark, folder):
    from checks.run import connect, difference
    from terrafold.llm.catalog import ORACLES, QUERIES

    con = connect(folder)
    for key, sql in ORACLES.items():
        assert difference(QUERIES[key](spark, folder).toPandas(), con.execute(sql).df()) is None


