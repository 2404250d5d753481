"""Post and page URLs."""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions.text import strip

HOST = r"^[a-z][a-z0-9+.\-]*://[^/?#]*"


def clean_url(url: Column) -> Column:
    """Cut at the first ``&`` and at the tracking parameter; NULL becomes empty."""
    cut = F.substring_index(F.coalesce(url, F.lit("")), "&", 1)
    return F.substring_index(cut, vocab.TRACKING_MARK, 1)


def url_key(url: Column, keep_params: Sequence[str] = tuple(vocab.IDENTITY_PARAMS)) -> Column:
    """Dedupe key of a URL: no query, except the parameters that identify the post.

    With ``keep_params=()`` the whole query goes, and all photo links share one key.
    """
    base = F.lower(strip(F.substring_index(url, "?", 1)))
    asked = F.lower(F.regexp_extract(url, r"\?([^#]*)", 1))
    kept = [
        F.when(
            F.regexp_extract(asked, rf"(?:^|&)({name}=[^&]*)", 1) != "",
            F.regexp_extract(asked, rf"(?:^|&)({name}=[^&]*)", 1),
        )
        for name in keep_params
    ]
    key = F.concat_ws("?", base, F.nullif(F.concat_ws("&", *kept), F.lit(""))) if kept else base
    return F.nullif(key, F.lit(""))


def is_safe_post_url(
    url: Column,
    allowed_host: str = vocab.POST_HOST,
    blocked_paths: Sequence[str] = tuple(vocab.BLOCKED_PATHS),
    blocked_params: Sequence[str] = tuple(vocab.COMMENT_PARAMS),
    permalink: str = vocab.PERMALINK_PATTERN,
    strict_host: bool = True,
) -> Column:
    """True for a link to a post on the allowed host.

    ``strict_host`` wants the host or a subdomain of it; otherwise the name may occur anywhere.
    """
    cleaned = F.lower(clean_url(url))
    name = re.escape(allowed_host)
    exact = rf"^[a-z][a-z0-9+.\-]*://(?:[^/?#]*\.)?{name}(?:[/?#]|$)"
    on_host = cleaned.rlike(exact if strict_host else rf"{HOST}{name}")
    tests = [on_host, cleaned.rlike(rf"{HOST}[^#]*?(?:{permalink})")]
    if blocked_paths:
        tests.append(~cleaned.rlike(rf"{HOST}[^?#]*?(?:{'|'.join(map(re.escape, blocked_paths))})"))
    if blocked_params:
        tests.append(~cleaned.rlike(rf"{HOST}[^?#]*\?[^#]*?(?:{'|'.join(map(re.escape, blocked_params))})"))
    return functools.reduce(lambda a, b: a & b, tests)


def post_url(url: Column, top_url: Column) -> Column:
    """Cleaned post link; the top-level link steps in when the first is missing or not safe."""
    first = clean_url(F.coalesce(F.nullif(url, F.lit("")), top_url))
    return F.when(~is_safe_post_url(first) & is_safe_post_url(top_url), clean_url(top_url)).otherwise(first)
