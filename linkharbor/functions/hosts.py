"""Hosts, URLs and reversed names, with regular expressions both engines read the same way."""

from __future__ import annotations

from linkharbor.functions.text import strip


def reverse_labels(name: str) -> str:
    """`com.example.blog` <-> `blog.example.com`."""
    return rf"array_join(reverse(split({name}, r'\.')), '.')"


# Scheme or, without any "://", none; user up to the last "@"; then a bracketed address or a name
# that ends at the port, the path or the end. Possessive, so a user name is never taken for a host.
_HOST = (
    r"^(?:[a-z][a-z0-9+.-]*+://|(?!.*://))(?:[^/?#]*@)?+"
    r"(\[[^\]/?#]*\]|[^:\[\]/?#]*(?=[:/?#]|$))"
)


# The host of a lower-case value that has nothing to clean: ASCII labels, no user, no bracket, a colon only
# after the scheme and before the port, tabs and line breaks only at the ends. Other values do not match.
_SIMPLE_HOST = (
    r"^\s*+(?:[a-z]++://)?+([\w-]++(?:\.[\w-]++)*+)(?::[0-9]++)?+(?:[/?#][^:\t\n\r]*+)?+\s*+\z"
)


def simple_host_or_empty(value: str) -> str:
    """As `host_or_empty` for the usual values, by one expression; '' for those that need more of it."""
    return f"regexp_extract(lower({value}), r'{_SIMPLE_HOST}', 1)"


def host_or_empty(value: str) -> str:
    """Lower-case host of a URL or bare name, without user, port and path; '' when there is none.

    One pass of one expression. Underscores and other characters a strict URI parser refuses are
    kept, as link data has them.
    """
    lowered = f"lower({strip(value)})"
    return remove(f"regexp_extract({remove(lowered, '\t', '\n', '\r')}, r'{_HOST}', 1)", "[", "]")


def normalize_host(value: str) -> str:
    """As `host_or_empty`, with null for no host. The array keeps it to one evaluation."""
    return f"get(array_remove(array({host_or_empty(value)}), ''), 0)"


def remove(text: str, *characters: str) -> str:
    """Without these characters; `replace` hands text back untouched when there is none."""
    for character in characters:
        text = f"replace({text}, '{character}')"
    return text


def absolute_url(value: str) -> str:
    """The trimmed URL when it has a scheme and an authority, else null."""
    return f"if(rlike({strip(value)}, r'^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]'), {strip(value)}, null)"
