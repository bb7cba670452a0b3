"""Text expressions: names, identifiers, locators, image references, globs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The authority number of minted identifiers, the longest slug, the
# shortest useful description, the URI scheme pattern.
DEFAULT_NAAN = "59853"
SLUG_MAX = 40
MIN_DESCRIPTION = 10
URI_SCHEME = r"\A[a-zA-Z][a-zA-Z0-9+.-]*://"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip every character up to U+0020 from both ends (Spark's trim strips blanks only)."""
    return F.btrim(col(c), F.lit("".join(map(chr, range(0x21)))))


def blank_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def slugify(name) -> Column:
    clean = F.regexp_replace(F.lower(F.coalesce(col(name), F.lit(""))), r"[^a-z0-9]+", "-")
    clean = F.regexp_replace(clean, r"\A-+|-+\z", "")
    clean = F.regexp_replace(F.substring(clean, 1, SLUG_MAX), r"-+\z", "")
    return F.coalesce(blank_to_null(clean), F.lit("unnamed"))


def mint_ark(prefix: str, name, source, naan: str = DEFAULT_NAAN) -> Column:
    """Deterministic identifier: class prefix, readable slug, 7 hex digits of SHA-1(source)."""
    return F.concat(F.lit(f"ark:{naan}/{prefix}-"), slugify(name), F.lit("-"),
                    F.substring(F.sha1(col(source)), 1, 7))


def bare_name(name) -> Column:
    c = col(name)
    return F.when(F.instr(c, ":") > 0, trim_ws(F.substring_index(c, ":", -1))).otherwise(c)


def basename(path) -> Column:
    return F.substring_index(col(path), "/", -1)


def extension(path) -> Column:
    """Text after the last dot of the last segment, '' when there is none."""
    return F.regexp_extract(basename(path), r"\.([^.]*)\z", 1)


def ensure_description(value, fallback) -> Column:
    return F.when(F.length(col(value)) >= MIN_DESCRIPTION, col(value)).otherwise(col(fallback))


def strip_script_delimiters(source) -> Column:
    """Drop the delimiters of a trailing triple-quoted block, keep what surrounds it."""
    return F.regexp_replace(col(source), r"""(?s)\A(.*?)(\"{3}|'{3})(.*)\2\s*\z""", "$1$3")


def unindent(source) -> Column:
    """The text without the blanks that all its lines with content begin with."""
    lines = F.split(col(source), "\n", -1)
    lead = F.transform(F.filter(lines, lambda s: s.rlike(r"\S")), lambda s: F.length(F.regexp_extract(s, r"\A[ \t]*", 0)))
    cut = F.coalesce(F.array_min(lead), F.lit(0))
    return F.array_join(F.transform(lines, lambda s: F.substr(s, cut + 1, F.length(s))), "\n")


def unquote(value) -> Column:
    v = trim_ws(value)
    return F.regexp_replace(v, r"""(?s)\A(["'])(.*)\1\z""", "$2")


def evidence_graph_id(node_id) -> Column:
    c = col(node_id)
    pattern = r"\Aark:/?(\d+)/(.*)\z"
    return F.when(c.rlike(pattern), F.regexp_replace(c, pattern, "ark:$1/evidence-graph-$2")) \
        .otherwise(F.concat(c, F.lit("-evidence-graph")))


def repository_of(image) -> Column:
    """Repository part of an image reference: no digest, no tag, registry port kept."""
    c = F.regexp_replace(blank_to_null(image), r"\A(.[^@]*)@.*\z", "$1")
    return F.regexp_replace(c, r"\A(.+):[^/:]*\z", "$1")


def pick_digest(image, digests) -> Column:
    named = F.filter(col(digests), lambda d: d != "")
    same = F.filter(named, lambda d: repository_of(d) == repository_of(image))
    return F.coalesce(F.get(same, F.lit(0)), F.get(named, F.lit(0)))


def file_shaped(text) -> Column:
    """The last path segment has a dot that is neither its first nor its last character."""
    return basename(text).rlike(r"\A[\s\S]+\.[^.]+\z")


def outside_locator(path) -> Column:
    """struct(content_url, local_path) for a file outside the crate."""
    c = blank_to_null(path)
    local = F.when(c.startswith("file://"), F.substring(c, 8, 1 << 30)) \
        .when(~c.rlike(URI_SCHEME), c)
    remote = F.when(~c.startswith("file://") & c.rlike(URI_SCHEME), c)
    return F.struct(remote.alias("content_url"), local.alias("local_path"))


def file_locator(path, crate_dir) -> Column:
    """Crate-relative content_url under the crate folder, otherwise an outside locator."""
    c, root = col(path), F.concat(F.regexp_replace(col(crate_dir), r"/+\z", ""), F.lit("/"))
    inside = F.startswith(c, root)
    outside = outside_locator(c)
    return F.struct(
        F.when(inside, F.substr(c, F.length(root) + 1)).otherwise(outside["content_url"]).alias("content_url"),
        F.when(~inside, outside["local_path"]).alias("local_path"))


def definition_locator(path, copied_to, crate_dir) -> Column:
    """A copy inside the crate wins over where the file came from."""
    away = file_locator(path, crate_dir)
    copy = blank_to_null(copied_to)
    return F.struct(F.coalesce(copy, away["content_url"]).alias("content_url"),
                    F.when(copy.isNull(), away["local_path"]).alias("local_path"))


def credited_names(contributors) -> Column:
    """Names of contributors credited as author, or of all when none is, joined by ', '."""
    c = col(contributors)
    authors = F.filter(c, lambda p: F.exists(p["contribution"], lambda t: F.lower(t) == "author"))
    chosen = F.when(F.size(authors) > 0, authors).otherwise(c)
    names = F.filter(F.transform(chosen, lambda p: p["name"]), lambda n: n != "")
    return blank_to_null(F.array_join(names, ", "))


def format_versions(pairs) -> Column:
    """One tool: its version. Several: 'tool version, tool version'. None: null."""
    c = col(pairs)
    return F.when(F.size(c) == 1, F.get(c, F.lit(0))["version"]) \
        .when(F.size(c) > 1, F.array_join(
            F.transform(c, lambda p: F.concat_ws(" ", p["tool"], p["version"])), ", "))


def param_value_text(value, kind) -> Column:
    """Parameter values as text: null is the word, lists and maps arrive as JSON text."""
    return F.coalesce(F.when(col(kind) == "null", F.lit("null")).otherwise(col(value)), F.lit("null"))


def script_lines(script) -> Column:
    """Non-blank stripped lines without the interpreter line."""
    body = F.regexp_replace(F.coalesce(col(script), F.lit("")), r"\A#![^\n]*\n", "")
    lines = F.transform(F.split(body, r"\r\n|\r|\n"), lambda s: F.regexp_replace(s, r"\A\s+|\s+\z", ""))
    return F.filter(lines, lambda s: s != "")


def contains_block(haystack, needle) -> Column:
    """Is one list of lines a contiguous run inside the other?"""
    wrap = lambda a: F.concat(F.lit("\n"), F.array_join(a, "\n"), F.lit("\n"))
    return (F.size(col(needle)) == 0) | F.contains(wrap(col(haystack)), wrap(col(needle)))


def truncate(value, limit: int) -> Column:
    c = col(value)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("..."))).otherwise(c)


def truncate_at_word(value, limit: int = 500) -> Column:
    """Cut to a limit, then back to the last blank before it."""
    c = col(value)
    head = F.substring(c, 1, limit)
    return F.when(F.length(c) > limit, F.regexp_replace(head, r"(?s)\A(.*) .*\z", "$1")).otherwise(c)


def abbreviate(name, limit: int = 50) -> Column:
    c = F.coalesce(col(name), F.lit(""))
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 3), F.lit("..."))).otherwise(c)


def glob_regex(pattern: str) -> str:
    """A path glob as an anchored regular expression (*, **, ?, [..], {a,b})."""
    out, i, depth = [], 0, 0
    while i < len(pattern):
        ch = pattern[i]
        if pattern.startswith("**", i):
            out.append(".*")
            i += 1
        elif ch == "*":
            out.append("[^/]*")
        elif ch == "?":
            out.append("[^/]")
        elif ch == "[":
            end = pattern.find("]", i + 1)
            body = pattern[i + 1:end]
            out.append("[" + ("^" + body[1:] if body.startswith("!") else body) + "]")
            i = end
        elif ch == "{":
            out.append("(?:")
            depth += 1
        elif ch == "}" and depth:
            out.append(")")
            depth -= 1
        elif ch == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(ch))
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def matches_globs(path, patterns: list[str], anywhere: bool = False) -> Column:
    """No pattern matches everything; ``anywhere`` lets a pattern match below any folder."""
    if not patterns:
        return F.lit(True)
    regexes = [glob_regex(f"**/{p}" if anywhere else p) for p in patterns]
    found = F.lit(False)
    for r in regexes:
        found = found | col(path).rlike(r)
    return found


def ancestors(path) -> Column:
    """Every proper ancestor folder of a path, shortest first ('a/b/c' -> 'a', 'a/b')."""
    c = col(path)
    lead = F.startswith(c, F.lit("/"))
    parts = F.split(F.regexp_replace(c, r"\A/", ""), "/")
    n = F.size(parts) - 1
    prefix = F.when(lead, F.lit("/")).otherwise(F.lit(""))
    return F.when(n >= 1, F.transform(
        F.sequence(F.lit(1), n), lambda k: F.concat(prefix, F.array_join(F.slice(parts, 1, k), "/"))
    )).otherwise(F.array().cast("array<string>"))
