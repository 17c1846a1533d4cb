"""Python-style patterns for Spark's Java regex engine.

Java group names allow no underscore, its character classes nest, and its classes are ASCII by
default. The helper runs once on the driver; the rows only see built-in Spark expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# White space as Python sees it. Spelled out: Java lacks U+001C-U+001F and looks others up slowly.
PYTHON_SPACE = r"\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@dataclass(frozen=True)
class JavaPattern:
    body: str  # without flags or anchor
    groups: dict[str, int]  # name -> group number
    n_groups: int

    def anchored(self, dotall: bool = True) -> str:
        """Match at the start only, as ``re.match`` does."""
        return f"(?{'s' if dotall else ''}Ud)\\A(?:{self.body})"

    def search(self) -> str:
        return f"(?Ud){self.body}"


def to_java(pattern: str) -> JavaPattern:
    compiled = re.compile(pattern)
    names = compiled.groupindex
    out: list[str] = []
    i, in_class = 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            pair = pattern[i : i + 2]
            if pair == r"\s":
                out.append(PYTHON_SPACE if in_class else f"[{PYTHON_SPACE}]")
            elif pair == r"\S" and not in_class:
                out.append(f"[^{PYTHON_SPACE}]")
            elif pair == r"\Z":
                out.append(r"\z")
            else:
                out.append(pair)
            i += 2
        elif in_class:
            if ch == "]":
                in_class = False
            out.append({"[": r"\[", "&": r"\&"}.get(ch, ch))
            i += 1
        elif ch == "[":
            in_class = True
            head = re.match(r"\[\^?\]?", pattern[i:]).group()
            out.append(head.replace("]", r"\]"))
            i += len(head)
        elif named := re.match(r"\(\?P<\w+>", pattern[i:]):
            out.append("(")
            i += named.end()
        elif back := re.match(r"\(\?P=(\w+)\)", pattern[i:]):
            out.append(f"(?:\\{names[back.group(1)]})")
            i += back.end()
        else:
            out.append(ch)
            i += 1
    return JavaPattern("".join(out), dict(names), compiled.groups)


def glob_to_regex(glob: str) -> str:
    """Path globs as whole-path Java patterns; ``**/`` spans any number of folders."""
    out: list[str] = []
    i = 0
    while i < len(glob):
        if glob.startswith("**/", i):
            out.append("(?:[^/.][^/]*/)*")
            i += 3
        elif glob[i] == "*":
            out.append("[^/]*")
            i += 2 if glob.startswith("**", i) else 1
        else:
            piece, i = _glob_char(glob, i)
            out.append(piece)
    return "".join(out)


def right_anchored_glob(glob: str) -> str | None:
    """Glob matched against the last segments of a path; ``**`` is exactly one segment.

    Returns None for an empty pattern, which matches nothing.
    """
    absolute = glob.startswith("/")
    segments = [s for s in glob.split("/") if s not in ("", ".")]
    if not segments:
        return None
    parts = []
    for segment in segments:
        i, piece = 0, ""
        while i < len(segment):
            if segment[i] == "*":
                piece += "[^/]*"
                i += 1
            else:
                ch, i = _glob_char(segment, i)
                piece += ch
        parts.append(piece)
    return ("^/" if absolute else "(?:^|/)") + "/".join(parts) + "$"


def _glob_char(glob: str, i: int) -> tuple[str, int]:
    ch = glob[i]
    if ch == "?":
        return "[^/]", i + 1
    if ch == "[":
        end = glob.find("]", i + 2 if glob.startswith("[!", i) or glob.startswith("[]", i) else i + 1)
        if end > 0:
            body = glob[i + 1 : end]
            negated = body.startswith("!")
            body = body[1:] if negated else body
            body = body.replace("\\", r"\\").replace("[", r"\[").replace("&", r"\&").replace("^", r"\^")
            return f"[{'^' if negated else ''}{body}]", end + 1
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", ch), i + 1
