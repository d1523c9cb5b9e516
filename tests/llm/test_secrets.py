import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

import brute
from ridemetrics.llm.secrets import base_spans, lexed_spans, literal_score, name_score, render, scan_secrets

KEY = "q8Zr2LxT9vWb4NcY7mKd"


def _values(text):
    return [text[a:b] for a, _, b in lexed_spans(text)]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    parts = ["password", "PASSWD", "token", "secret", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH0123", "0123456789abcdef", "é", "abc", "\n", "toſen", "Key", "-", "=="]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(0, 14)))
        assert [(s, k, e) for s, k, _, e in brute.secrets(text)] == base_spans(text), text


def test_short_match_hides_what_it_covers():
    assert base_spans("secret=token:abcdefgh") == []
    assert render(base_spans("token=abcdef")) == "assign:0:12"


def test_lexer_reads_pairs_of_several_syntaxes():
    assert _values(f'db_password = "{KEY}"') == [KEY]
    assert _values(f"  clientSecret: {KEY}") == [KEY]
    assert _values(f'{{"auth_token": "{KEY}", "count": 5}}') == [KEY]
    assert _values(f"'private-key' => '{KEY}'") == [KEY]
    assert _values(f'signingKey := "{KEY}"') == [KEY] or name_score("signingKey") < 3


def test_constants_are_propagated():
    text = f'X = "{KEY}"\nY = X\napi_secret = Y\n'
    assert _values(text) == [KEY]
    assert _values(f'a = "{KEY[:10]}" + "{KEY[10:]}"\npassword = a') == [KEY[:10], KEY[10:]]
    assert _values(f'X = "{KEY}"\nX = "other"\npassword = X') == []


@pytest.mark.parametrize(
    "text",
    [
        "apiSecret = `{}`", "token = `{}\n`", 'password = """{}"""', "secret = '''\n{}'''", "password: str = '{}'", "auth_token = r'{}'",
        "password: |\n  {}\nuser: x", "a:\n  secret: >-\n      {}\n  b: 1", '<add key="db_password" value="{}"/>',
        "<property name='apiSecret'\n  value='{}' />", "<password>{}</password>", 'clientSecret = "{}" // old', "# password = '{}'",
        "/* secret: '{}' */", "connect(user='me', password='{}')", 'p = "{}"\ntoken_secret = p', "export API_SECRET={}",
    ],
)
def test_syntaxes(text):
    assert [v.strip() for v in _values(text.format(KEY))] == [KEY]


def test_sums_of_names_and_literals():
    a, b = KEY[:9], KEY[9:]
    assert _values(f'p = "{a}"\npassword = p + "{b}"') == [a, b]
    assert _values(f'p = "{a}"\npassword = p+"{b}"') == [a, b]
    assert _values(f'p = "{b}"\npassword = "{a}" +\n    p') == [b, a]
    assert _values(f'password = "{a}" "{b}"') == [a, b]
    # Each literal once, whatever refers to it.
    assert _values(f'p = "{KEY}"\n' + "token = p\npassword = p + p\n" * 3) == [KEY]


def test_blocks_end_with_their_indent():
    assert _values(f"secret: |\n   {KEY[:10]}\n\n   {KEY[10:]}\ntitle: {KEY}x\n") == [KEY[:10], KEY[10:]]


LONG = [
    f'p = "{KEY * 1000}"\n' + "token=p\n" * 250_000,
    f'a = "{KEY}"\n' + "a = a + a\n" * 2000 + "password = a\n" * 1000,
    "password = '" * 150_000, 'token: """' * 200_000, "secret=`" * 250_000, "key: |\n " * 250_000, "<a>" * 700_000, "a.b-" * 500_000,
    "password: " + "x" * 2_000_000, '"' * 2_000_000, "a:b=" * 500_000, "p+" * 1_000_000, "key='a' " * 250_000, "x = '\\" * 300_000,
    "a=" + "'b'" * 600_000, "a = b +\n" * 250_000, "a:" + " " * 2_000_000, "<a>b" * 500_000, "a: |\n" + "  b\n" * 500_000,
]


@pytest.mark.parametrize("number", range(len(LONG)))
def test_time_grows_with_the_text(number):
    """Some 2 MB each."""
    start = time.process_time()
    lexed_spans(LONG[number])
    assert time.process_time() - start < 5


def test_harmless_names_and_values_are_left_alone():
    assert _values(f'title = "{KEY}"') == []
    assert _values('password = "changeme changeme"') == []
    assert _values("token_count: 1234567890") == []
    assert _values('password_hint = "aaaaaaaaaaaa"') == []
    assert literal_score("a b c d e f g") < 0 < literal_score(KEY)


def test_query_columns_and_edges(spark):
    rows = [(1, f'é token = "{KEY}"'), (2, None), (2, ""), (None, "0" * 24), (3, "x = y\n" * 5000), (4, 'a="' + " " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = scan_secrets(docs).collect()
    assert len(got) == len(rows)
    one = next(r for r in got if r.doc_id == 1)
    assert one.spans == f"assign:2:{11 + len(KEY)},lexed:11:{11 + len(KEY)}"
    for r in got:
        text = next(t for d, t in rows if d == r.doc_id)
        spans = brute.secrets(text)
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
    assert scan_secrets(docs.limit(0)).count() == 0
