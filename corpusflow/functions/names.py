"""Names and paths of repositories, archives and binaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prefix of paths recorded inside the build container, and archive endings.
CONTAINER_ROOT = "/usr/src/repo/"
ARCHIVE_ENDING = {"gzip": ".tar.gz", "xz": ".tar.xz"}


def repo_segments(line: Column) -> Column:
    """Path segments of a repository URL without trailing slashes and one ``.git`` ending."""
    url = F.rtrim(F.regexp_replace(line, r"^\s+|\s+$", ""), F.lit("/"))
    return F.split(F.regexp_replace(url, r"\.git$", ""), "/")


def repo_owner(line: Column) -> Column:
    return F.try_element_at(repo_segments(line), F.lit(-2))


def repo_name(line: Column) -> Column:
    return F.try_element_at(repo_segments(line), F.lit(-1))


def full_name(owner: Column, name: Column) -> Column:
    return F.concat_ws("/", owner, name)


def folder_name(owner: Column, name: Column) -> Column:
    """Flat folder name, so that owners need no folders of their own."""
    return F.concat_ws("_____", owner, name)


def archive_path(folder: str, owner: Column, name: Column, compression: Column) -> Column:
    """Archive of a repository; an unknown compression is an error."""
    ending = F.lit(None).cast("string")
    for kind, text in ARCHIVE_ENDING.items():
        ending = F.when(compression == kind, text).otherwise(ending)
    ending = F.coalesce(ending, F.raise_error(F.concat(F.lit("invalid compression: "), compression)))
    return F.concat(F.lit(folder.rstrip("/") + "/"), full_name(owner, name), ending)


def without_prefix(text: Column, prefix: str) -> Column:
    return F.when(F.startswith(text, F.lit(prefix)), F.substr(text, F.lit(len(prefix) + 1))).otherwise(text)


def path_in_repo(owner: Column, name: Column, directory: Column, path: Column) -> Column:
    """Container path of a binary, re-rooted at ``owner/name``."""
    return F.concat_ws("/", owner, name, without_prefix(directory, CONTAINER_ROOT), path)


def drop_segments(path: Column, count: int) -> Column:
    """The path without its first ``count`` segments."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, count + 1, F.greatest(F.size(parts) - count, F.lit(0))), "/")


def relative_to(path: Column, root: str) -> Column:
    """Path relative to a root folder above it; the root itself is ``.``."""
    root = root.rstrip("/")
    return F.when(path == root, ".").otherwise(without_prefix(path, root + "/"))


def last_segment(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_elf(content: Column) -> Column:
    """Whether the bytes begin with the ELF magic number."""
    return F.coalesce(F.startswith(content, F.unhex(F.lit("7F454C46"))), F.lit(False))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def first_line_contains(text: Column, wanted: str) -> Column:
    """Whether the first line holds the wanted text; no file counts as no."""
    return F.coalesce(F.contains(F.substring_index(text, "\n", 1), F.lit(wanted)), F.lit(False))


def untracked_names(output: Column) -> Column:
    """Names in an untracked-file listing: escapes are decoded, then lines split and quotes taken off."""
    pieces = F.regexp_extract_all(
        output, F.lit(r"\\[0-7]{1,3}|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\[\s\S]|[^\\]+|\\"), F.lit(0)
    )
    # Single-letter escapes.
    letters = F.create_map(
        *[F.lit(x) for pair in {
            "\\a": "\a", "\\b": "\b", "\\f": "\f", "\\n": "\n", "\\r": "\r",
            "\\t": "\t", "\\v": "\v", "\\\\": "\\", "\\'": "'", '\\"': '"', "\\\n": "",
        }.items() for x in pair]
    )

    def code_point(hexadecimal: Column) -> Column:
        return F.decode(F.unhex(F.lpad(hexadecimal, 4, "0")), "UTF-16BE")

    def decoded(piece: Column) -> Column:
        return (
            F.when(piece.rlike(r"^\\[0-7]"), code_point(F.conv(F.substring(piece, 2, 3), 8, 16)))
            .when(piece.rlike(r"^\\[xu][0-9a-fA-F]"), code_point(F.substring(piece, 3, 4)))
            .otherwise(F.coalesce(F.try_element_at(letters, piece), piece))
        )

    text = F.when(F.contains(output, F.lit("\\")), F.array_join(F.transform(pieces, decoded), "")).otherwise(output)
    lines = F.filter(F.split(text, "\n"), lambda line: line != "")
    return F.transform(
        lines, lambda line: F.when(F.startswith(line, F.lit('"')), line.substr(F.lit(2), F.length(line) - 2)).otherwise(line)
    )
