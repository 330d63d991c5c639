"""Path functions (Column -> Column), all JVM-side.

F1 path_prefilter, F2 relativize, F3 normalize_rel, F4 path_parts / join_base,
F5 detect_language, plus the directory helpers used by the listing (S1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's behaviour.
# Directory names skipped while listing a tree.
TREE_EXCLUDE_DIRS = [
    "node_modules", ".git", ".next", "dist", "build", "__pycache__",
    ".venv", ".idea", ".vscode", ".DS_Store", ".turbo", ".husky",
]
# Directory names skipped while flattening a stored tree (S3).
FLATTEN_EXCLUDE_DIRS = [
    "node_modules", ".git", "dist", "build", "__pycache__", ".venv", ".idea", ".vscode", "coverage", "Archive",
]
# Paths dropped before selection (F1): tests, docs, assets; searched anywhere, case-insensitive.
PREFILTER_PATTERN = (
    r"(\.test\.|\.spec\.|\.mock\.|/tests?/|/__tests__/|README|LICENSE|\.md$|\.png$|\.jpg$|\.jpeg$|\.gif$|\.svg$"
    r"|\.ico$|\.lock$|yarn\.lock|package-lock\.json|\.map$|\.snap$|\.log$|/fixtures?/|\.sample\.|\.css$|\.scss$|\.less$)"
)
# Extension -> language (F5); other extensions give the extension without its dot, case kept.
EXT_TO_LANG = {
    ".js": "js",
    ".jsx": "jsx",
    ".ts": "ts",
    ".tsx": "tsx",
    ".py": "python",
    ".json": "json",
    ".yml": "yaml",
    ".yaml": "yaml",
    ".html": "html",
    ".css": "css",
}
# ---------------------------------------------------------------------------

# Java regex flags: case-insensitive with Unicode case folding (matches Python's re.I on str).
# Python's `$` also matches before a final "\n"; Java's `$` additionally before "\r", U+0085, U+2028/9,
# so UNIX_LINES (?d) keeps the end anchor to "\n" only, as in Python.
_PREFILTER_JAVA = "(?iud)" + PREFILTER_PATTERN


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def path_prefilter_match(path: Column | str) -> Column:
    """True when the path is a test/doc/asset path (F1); keep rows where this is False."""
    return _c(path).rlike(_PREFILTER_JAVA)


def normalize_rel(path: Column | str) -> Column:
    """backslashes to '/', drop a leading drive, then leading '/', collapse '//'; null -> ''."""
    s = F.replace(F.coalesce(_c(path), F.lit("")), F.lit("\\"), F.lit("/"))
    s = F.regexp_replace(s, r"^[A-Za-z]:/", "")
    s = F.regexp_replace(s, r"^/+", "")
    return F.regexp_replace(s, r"/{2,}", "/")


def path_parts(path: Column | str) -> Column:
    """normalised parts without '' and '.'; '..' is kept (see join_base)."""
    return F.filter(F.split(normalize_rel(path), "/"), lambda p: (p != "") & (p != "."))


def join_base(base: Column | str, rel: Column | str, reject_parent: bool = True) -> Column:
    """base joined with the normalised parts of rel.

    The reference does not stop '..'; here a path with a '..' part gives null unless
    ``reject_parent=False``.
    """
    parts = path_parts(rel)
    joined = F.when(F.size(parts) == 0, _c(base)).otherwise(
        F.concat(F.regexp_replace(_c(base), "/+$", ""), F.lit("/"), F.array_join(parts, "/"))
    )
    if reject_parent:
        return F.when(F.array_contains(parts, ".."), F.lit(None).cast("string")).otherwise(joined)
    return joined


def base_name(path: Column | str) -> Column:
    """Last non-empty component, like ``PurePath.name``."""
    parts = F.filter(F.split(_c(path), "/"), lambda p: p != "")
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))


def relativize(path: Column | str, base: str) -> Column:
    """path relative to ``base`` when it lies below it, else the base name only."""
    p = F.regexp_replace(_c(path), "/{2,}", "/")
    b = base.rstrip("/")
    if not b:
        return F.when(p.startswith("/"), base_name(p)).otherwise(F.regexp_replace(p, "/+$", ""))
    prefix = b + "/"
    return (
        F.when(p == F.lit(b), F.lit("."))
        .when(p.startswith(prefix), F.regexp_replace(F.substring(p, len(prefix) + 1, 1 << 30), "/+$", ""))
        .otherwise(base_name(p))
    )


def suffix(path: Column | str) -> Column:
    """``PurePath.suffix``: last '.xxx' of the last component; '' for '.gitignore', 'foo.', 'Makefile'."""
    return F.regexp_extract(_c(path), r"^(?:.*/)?[^/]+(\.[^/.]+)$", 1)


def detect_language(path: Column | str) -> Column:
    """mapped language for known extensions (case-insensitive), else the bare extension."""
    sfx = suffix(path)
    low = F.lower(sfx)
    expr = None
    for ext, lang in EXT_TO_LANG.items():
        expr = F.when(low == ext, F.lit(lang)) if expr is None else expr.when(low == ext, F.lit(lang))
    return expr.otherwise(F.substring(sfx, 2, 1 << 30))


def parent_dirs(path: Column | str) -> Column:
    """Directory components of a relative path (all but the last part)."""
    parts = F.split(_c(path), "/")
    return F.slice(parts, 1, F.size(parts) - 1)


def ancestor_dirs(path: Column | str) -> Column:
    """Every ancestor directory of a file path, as prefixes: 'a/b/c.js' -> ['', 'a', 'a/b'].

    '' stands for the repository root, so selecting the root expands to every file.
    """
    dirs = parent_dirs(path)
    # sequence(1, 0) is [1, 0], so files at the root get only ''.
    below = F.when(
        F.size(dirs) > 0,
        F.transform(F.sequence(F.lit(1), F.size(dirs)), lambda n: F.array_join(F.slice(dirs, 1, n), "/")),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array(F.lit("")), below)
