"""Text, flag and number clean-up of raw string columns."""

from __future__ import annotations

from linkharbor.config import sql_list

# The characters that count as white space when a field is trimmed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
TRUE_WORDS = ("1", "true", "t", "yes", "y")


def strip(text: str) -> str:
    return f"btrim({text}, '{WHITESPACE}')"


def clean_text(text: str) -> str:
    """Trimmed text, null when nothing is left."""
    return f"nullif({strip(text)}, '')"


def parse_bool(text: str) -> str:
    return f"coalesce(lower({strip(text)}) in ({sql_list(TRUE_WORDS)}), false)"


def has_token(text: str, token: str) -> str:
    """True when the token is one of the white-space separated words, in any case."""
    spaces = " " * len(WHITESPACE)
    words = f"concat(' ', translate(lower({text}), '{WHITESPACE}', '{spaces}'), ' ')"
    return f"coalesce(contains({words}, ' {token} '), false)"


def infer_nofollow(is_nofollow: str, rel: str) -> str:
    """A nofollow token in rel sets the flag; nothing resets it."""
    return f"(coalesce({is_nofollow}, false) or {has_token(rel, 'nofollow')})"


def optional_number(text: str, to_type: str, strict: bool = False) -> str:
    """Blank becomes null. Other text that is no number raises when strict, else becomes null."""
    return f"{'cast' if strict else 'try_cast'}({clean_text(text)} as {to_type})"


def is_bad_number(text: str, to_type: str) -> str:
    return f"({clean_text(text)} is not null and {optional_number(text, to_type)} is null)"
