"""Ordered rule lists, compiled to one conditional expression: the first rule that holds wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def first_match(rules: Sequence[Rule], otherwise: str | None = None) -> Column:
    out = None
    for value, test in rules:
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


def by_pattern(c: Column, patterns: Sequence[tuple[str, str]], otherwise: str | None = None) -> Column:
    """Rules given as (value, regular expression) over one text, without regard to case."""
    return first_match([(value, c.rlike(f"(?i){p}")) for value, p in patterns], otherwise)


def external_link_kind(host: Column) -> Column:
    """Kind of an outside link by its host; any host that holds x.com counts as the micro-blog."""
    return first_match(
        [("FACEBOOK", host.contains("facebook")), ("LINKEDIN", host.contains("linkedin")), ("INSTAGRAM", host.contains("instagram")), ("TWITTER", host.contains("x.com") | host.contains("twitter"))],
        "WEBSITE",
    )


def reachability(status: Column, html: Column, challenge: Sequence[str] = ("captcha", "access denied", "cloudflare")) -> Column:
    """Below 400 reachable; 403 and 503 with a bot check are a challenge; all else is unreachable."""
    blocked = F.lit(False)
    for word in challenge:
        blocked = blocked | F.coalesce(F.lower(html).contains(word), F.lit(False))
    return first_match([("reachable", status < 400), ("challenge", status.isin(403, 503) & blocked)], "unreachable")


def workflow_branch(value: Column, default: str = "structured_archive", valid: Sequence[str] = ("structured_archive", "mint")) -> Column:
    """Absent means the default; a value outside the list is null, for the caller to quarantine."""
    return F.when(value.isNull(), F.lit(default)).when(value.isin(*valid), value)


#: Fixed values: (code, pattern) of submission errors, the more specific ones first.
SUBMIT_ERRORS = [
    ("60401", "already known"),
    ("60402", "nonce too low"),
    ("60403", "insufficient funds"),
    ("60411", "contract creation code storage out of gas"),
    ("60404", "gas required exceeds|out of gas"),
    ("60405", "transaction underpriced|replacement transaction"),
    ("60406", "execution reverted|revert"),
    ("60407", "invalid transaction|invalid sender"),
    ("60408", "ECONNREFUSED|ETIMEDOUT|network error"),
    ("60409", "timeout|ESOCKETTIMEDOUT"),
    ("60410", "invalid argument|invalid params"),
]
UNKNOWN_ERROR = "60999"


def submit_error(message: Column) -> Column:
    """Code of a submission error; the message inside a JSON reply counts, where there is one. Blank or null: unknown."""
    inner = [F.get_json_object(message, p) for p in ("$.error.message", "$.message", "$.error")]
    shown = F.when(message.rlike(r"^[\[{]"), F.coalesce(*[F.nullif(i, F.lit("")) for i in inner], message)).otherwise(message)
    return by_pattern(F.coalesce(shown, F.lit("")), SUBMIT_ERRORS, UNKNOWN_ERROR)
