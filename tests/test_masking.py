"""Masking rules against plain-Python statements of them, on random text."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from marketlake.functions import masking
from marketlake.functions.masking import mask_columns

EDGE = ["", "a", "ab", "abc", "abcd", "abcde", "@", "a@b", "ab@c.de", "abc@d@e", "x y", "  two  words ", "été naïve", "日本語文字", "123456789", "4111 1111 1111 1111"]


def samples() -> list[str]:
    rng = random.Random(11)
    made = ["".join(rng.choice("0123456789 -().+ab@") for _ in range(rng.randint(0, 24))) for _ in range(1500)]
    made += ["".join(rng.choice("0123456789 -") for _ in range(rng.randint(5, 24))) for _ in range(800)]
    return EDGE + made


def keep_last_four(v: str, separators: str) -> str:
    solid = [i for i, ch in enumerate(v) if ch not in separators]
    if len(solid) <= 4:
        return "*" * len(v)
    hidden = set(solid[:-4])
    return "".join("*" if i in hidden else ch for i, ch in enumerate(v))


def email(v: str) -> str:
    user, at, domain = v.partition("@")
    if not at:
        return v
    shown = "*" * len(user) if len(user) < 3 else f"{user[0]}{'*' * (len(user) - 2)}{user[-1]}"
    return f"{shown}@{domain}"


def partial(v: str) -> str:
    k = len(v) // 3
    return "*" * len(v) if len(v) < 5 else v[:k] + "*" * k + v[2 * k :]


def personal_id(v: str) -> str:
    return "*" * len(v) if len(v) < 5 else v[0] + "*" * (len(v) - 2) + v[-1]


def detected(v: str) -> str:
    digits = lambda seps: re.sub(f"[{seps}]", "", v)
    if re.fullmatch(r"[\w.%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", v, re.ASCII):
        return email(v)
    if re.fullmatch(r"\d{7,15}", digits(r" \-()."), re.ASCII):
        return keep_last_four(v, " -().")
    if re.fullmatch(r"\d{9}|\d{13,19}", digits(r" \-"), re.ASCII):
        return keep_last_four(v, " -")
    return partial(v)


EXPECTED = {
    "email": email,
    "phone": lambda v: keep_last_four(v, " -()."),
    "credit_card": lambda v: keep_last_four(v, " -"),
    "ssn": lambda v: keep_last_four(v, " -"),
    "personal_id": personal_id,
    "name": lambda v: " ".join(w[0] + "*" * (len(w) - 1) for w in v.split()),
    "hash": lambda v: hashlib.sha256((v + masking.DEFAULT_SALT).encode()).hexdigest(),
    "remove": lambda v: "[REMOVED]",
    "anything else": partial,
    "default": detected,
}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, v, v) for i, v in enumerate(samples())], "id int, raw string, v string").cache()


@pytest.mark.parametrize("rule", EXPECTED)
def test_rule(texts, rule):
    for row in mask_columns(texts, [f"v:{rule}"]).collect():
        assert row.v == EXPECTED[rule](row.raw), row.raw


def test_no_rule_means_default_and_null_stays_null(spark):
    df = spark.createDataFrame([("a@example.com",), (None,)], "v string")
    assert [r.v for r in mask_columns(df, ["v"]).collect()] == ["*@example.com", None]
    assert [r.v for r in mask_columns(df, ["v:remove"]).collect()] == ["[REMOVED]", None]


def test_tab_in_a_phone_number_is_masked_not_passed_through(spark):
    df = spark.createDataFrame([("555\t123 4567",)], "v string")
    assert mask_columns(df, ["v:phone"]).first().v.endswith("4567")
    assert "555" not in mask_columns(df, ["v:phone"]).first().v


def test_numbers_are_masked_as_text(spark):
    df = spark.createDataFrame([(12345678.5, 123456789, True, 1.5)], "d double, n bigint, b boolean, s double")
    row = mask_columns(df, ["d:personal_id", "n:personal_id", "b:partial", "s:partial"]).first()
    assert (row.d, row.n, row.b, row.s) == ("1********5", "1*******9", "****", "***")


def test_nested_paths(spark):
    df = spark.sql(
        """SELECT named_struct('mail', 'someone@example.com', 'ids', array('abcdef', 'ghijkl', NULL)) AS who,
                  array(named_struct('k', 'secret-one', 'n', 1), named_struct('k', 'secret-two', 'n', 2)) AS rows,
                  map('a', 'first value', 'b', 'other value') AS tags"""
    )
    out = mask_columns(df, ["who.mail:email", "who.ids[1]:personal_id", "rows[0].k:remove", "tags.b:remove"]).first()
    assert out.who.mail == "s*****e@example.com"
    assert out.who.ids == ["abcdef", "g****l", None]
    assert [(r.k, r.n) for r in out.rows] == [("[REMOVED]", 1), ("secret-two", 2)]
    assert out.tags == {"a": "first value", "b": "[REMOVED]"}


def test_whole_containers(spark):
    df = spark.sql("SELECT array('abcde', 'x') AS list, map('k', 'abcde') AS m, named_struct('p', 'abcde', 'q', 7) AS s")
    out = mask_columns(df, ["list:personal_id", "m:personal_id", "s:personal_id"]).first()
    assert (out.list, out.m, (out.s.p, out.s.q)) == (["a***e", "*"], {"k": "a***e"}, ("a***e", "*"))


@pytest.mark.parametrize("spec", ["absent", "v.inner", "v[0]", "absent.a[1]:email"])
def test_unresolved_paths_change_nothing(spark, spec):
    df = spark.createDataFrame([("text",)], "v string")
    assert mask_columns(df, [spec]).collect() == df.collect()


def test_salt_and_custom_rule(spark):
    df = spark.createDataFrame([("x",)], "v string")
    assert mask_columns(df, ["v:hash"], salt="s").first().v == hashlib.sha256(b"xs").hexdigest()
    masking.register_rule("shout", F.upper)
    assert mask_columns(df, ["v:shout"]).first().v == "X"
    del masking.RULES["shout"]
