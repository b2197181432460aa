"""Field masking as column expressions.

``mask_columns(df, ["email:email", "contact.phones[0]:phone", "owner"])`` masks top-level columns, struct
fields, map values and array elements. A spec without a rule detects one per value. A path that does not
resolve leaves the frame unchanged. Masked values are text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = Callable[[Column], Column]

# Default salt, replacement text and detection patterns.
DEFAULT_SALT = "financial-market-data-masking-salt"
REMOVED = "[REMOVED]"
EMAIL_PATTERN = r"(?d)^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_SEPARATORS = r"(?U)[\s\-().]"
CARD_SEPARATORS = r"(?U)[\s\-]"
PHONE_DIGITS = (7, 15)
CARD_DIGITS = (13, 19)
SSN_DIGITS = (9, 9)


def stars(n: Column) -> Column:
    return F.repeat(F.lit("*"), n.cast("int"))


def mask_email(v: Column) -> Column:
    """First and last letter of the user part stay; up to two letters are all masked."""
    at = F.instr(v, "@")
    user = F.substr(v, F.lit(1), at - 1)
    size = at - 1
    hidden = F.when(size <= 2, stars(size)).otherwise(F.concat(F.left(user, F.lit(1)), stars(size - 2), F.right(user, F.lit(1))))
    return F.when(at == 0, v).otherwise(F.concat(hidden, F.substr(v, at)))


def _keep_last_four(separators: str, literal: str) -> Rule:
    """Mask all but the last four characters that are not separators; separators stay in place."""

    def rule(v: Column) -> Column:
        bare = F.regexp_replace(v, separators, "")
        hidden = F.regexp_replace(v, f"[^{literal}](?=(?:[{literal}]*+[^{literal}]){{4}})", "*")
        return F.when(F.length(bare) <= 4, stars(F.length(v))).otherwise(hidden)

    return rule


mask_phone = _keep_last_four(PHONE_SEPARATORS, r" \-().")
mask_card = _keep_last_four(CARD_SEPARATORS, r" \-")
mask_ssn = mask_card


def mask_personal_id(v: Column) -> Column:
    size = F.length(v)
    ends = F.concat(F.left(v, F.lit(1)), stars(size - 2), F.right(v, F.lit(1)))
    return F.when(size <= 4, stars(size)).otherwise(ends)


def mask_name(v: Column) -> Column:
    """Per word the first letter and stars; one-letter words stay; runs of blanks become one."""
    words = F.filter(F.split(v, r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.left(w, F.lit(1)), stars(F.length(w) - 1))), " ")


def mask_partial(v: Column) -> Column:
    """The middle third; up to four characters are all masked."""
    size = F.length(v)
    third = F.floor(size / 3)
    middle = F.concat(F.substr(v, F.lit(1), third), stars(third), F.substr(v, third * 2 + 1))
    return F.when(size <= 4, stars(size)).otherwise(middle)


def mask_hash(salt: str = DEFAULT_SALT) -> Rule:
    return lambda v: F.sha2(F.concat(v, F.lit(salt)), 256)


def mask_remove(v: Column) -> Column:
    return F.when(v.isNotNull(), F.lit(REMOVED))


def _digits_between(v: Column, separators: str, least: int, most: int) -> Column:
    bare = F.regexp_replace(v, separators, "")
    return bare.rlike(r"^\p{Nd}+\z") & F.length(bare).between(least, most)


def mask_default(v: Column) -> Column:
    """Detect email, phone, card, ssn in that order, else partial."""
    return (
        F.when(v.rlike(EMAIL_PATTERN), mask_email(v))
        .when(_digits_between(v, PHONE_SEPARATORS, *PHONE_DIGITS), mask_phone(v))
        .when(_digits_between(v, CARD_SEPARATORS, *CARD_DIGITS), mask_card(v))
        .when(_digits_between(v, CARD_SEPARATORS, *SSN_DIGITS), mask_ssn(v))
        .otherwise(mask_partial(v))
    )


RULES: dict[str, Rule] = {
    "default": mask_default,
    "email": mask_email,
    "phone": mask_phone,
    "credit_card": mask_card,
    "ssn": mask_ssn,
    "personal_id": mask_personal_id,
    "name": mask_name,
    "hash": mask_hash(),
    "remove": mask_remove,
}


def register_rule(name: str, rule: Rule) -> None:
    RULES[name] = rule


def rule_named(name: str, salt: str = DEFAULT_SALT) -> Rule:
    """A rule by name; unknown names mask partially."""
    if name == "hash" and salt != DEFAULT_SALT:
        return mask_hash(salt)
    return RULES.get(name, mask_partial)


def as_text(value: Column, kind: T.DataType) -> Column:
    """A scalar as the text that is masked: plain digits for large doubles, True/False for booleans."""
    text = value.cast("string")
    if isinstance(kind, T.BooleanType):
        return F.initcap(text)
    if isinstance(kind, T.DoubleType):
        size = F.abs(value)
        digits = F.regexp_replace(text.try_cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
        return F.when((size >= 1e7) & (size < 1e16), digits).otherwise(text)
    return text


def mask_value(value: Column, kind: T.DataType, rule: Rule) -> Column:
    """Apply a rule to a scalar, to each array element, map value or struct field; NULL stays NULL."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: mask_value(x, kind.elementType, rule))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: mask_value(x, kind.valueType, rule))
    if isinstance(kind, T.StructType):
        fields = [mask_value(value[f.name], f.dataType, rule).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return rule(as_text(value, kind))


Step = str | int


def parse_spec(spec: str) -> tuple[list[Step], str]:
    """``"a.b[0]:rule"`` to ``(["a", "b", 0], "rule")``."""
    path, _, rule = spec.partition(":")
    steps: list[Step] = []
    for part in path.split("."):
        indexed = re.fullmatch(r"(.*)\[(\d+)\]", part)
        steps += [indexed[1], int(indexed[2])] if indexed else [part]
    return steps, rule or "default"


def _resolves(kind: T.DataType, steps: list[Step]) -> bool:
    if not steps:
        return True
    step, rest = steps[0], steps[1:]
    if isinstance(step, int):
        return isinstance(kind, T.ArrayType) and _resolves(kind.elementType, rest)
    if isinstance(kind, T.MapType):
        return _resolves(kind.valueType, rest)
    return isinstance(kind, T.StructType) and step in kind.names and _resolves(kind[step].dataType, rest)


def _mask_at(value: Column, kind: T.DataType, steps: list[Step], rule: Rule) -> Column:
    if not steps:
        return mask_value(value, kind, rule)
    step, rest = steps[0], steps[1:]
    if isinstance(kind, T.StructType):
        return value.withField(step, _mask_at(value[step], kind[step].dataType, rest, rule))

    # siblings of a masked element take the same type: text where the masked value is text
    def masked(x: Column, inner: T.DataType) -> Column:
        return _mask_at(x, inner, rest, rule)

    def sibling(x: Column, inner: T.DataType) -> Column:
        return _mask_at(x, inner, rest, lambda text: text)

    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        return F.transform(value, lambda x, i: F.when(i == step, masked(x, inner)).otherwise(sibling(x, inner)))
    inner = kind.valueType
    return F.transform_values(value, lambda k, x: F.when(k == step, masked(x, inner)).otherwise(sibling(x, inner)))


def mask_columns(df: DataFrame, specs: Iterable[str], salt: str = DEFAULT_SALT) -> DataFrame:
    for spec in specs:
        steps, rule = parse_spec(spec)
        if _resolves(df.schema, steps):
            top, rest = steps[0], steps[1:]
            kind = df.schema[top].dataType
            df = df.withColumn(top, _mask_at(df[top], kind, rest, rule_named(rule, salt)))
    return df
