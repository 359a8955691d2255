"""C source text and decompiler output: cleaning, names and variables, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the decompiler output and of the marker lines.
FUNCTION_IN_JSON = r'"function":\s*"([^"]+)"'
VARIABLE = r"@@VAR_(\d+)@@([^@]+)@@([_a-zA-Z0-9]+)"
REGISTER = r"@<[a-z0-9]+>"
LINE_CONTROL_WITH_NEWLINE = r"(?m)^#[^\n]*\n"
LINE_CONTROL = r"(?m)^#[^\n]*$"
HEADER_END = "typedef int __end_of_fake_libc__;"
MARKER = "typedef int __func__"
MARKER_BEGIN = "__begin;"
MARKER_END = "__end;"
JSON_SCHEMA = "function string, raw_code string, _corrupt string"
# Limits of the JSON reader, set out of reach: lines may nest and names may be as long as they like.
JSON_OPTIONS = {"maxNestingDepth": str((1 << 31) - 1), "maxStringLen": str((1 << 31) - 1), "maxNumLen": str((1 << 31) - 1)}

# Words of the C language.
KEYWORDS = [
    "auto", "break", "case", "char", "const", "continue", "default", "do", "double", "else", "enum", "extern",
    "float", "for", "goto", "if", "inline", "int", "long", "offsetof", "register", "restrict", "return", "short",
    "signed", "sizeof", "static", "struct", "switch", "typedef", "union", "unsigned", "void", "volatile", "while",
    "_Bool", "_Complex", "_Noreturn", "_Static_assert", "_Thread_local", "__int128",
]
# Words that may stand before the type of a function, and words that are never its name.
SPECIFIERS = [
    "static", "extern", "inline", "register", "typedef", "auto", "const", "volatile", "restrict", "_Noreturn",
    "_Thread_local", "struct", "union", "enum", "__inline", "__inline__", "__extension__",
]
NOT_A_NAME = ["__attribute__", "__attribute", "__asm__", "__asm", "__declspec", "__typeof__", "typeof"]
# Tokens after which an undefined type stands itself.
QUALIFIERS = ["const", "volatile", "restrict", "__const", "__restrict", "__extension__", ","]

# Dialect of the decompiler. Dropped words, replaced words, macros dropped with their arguments.
DROPPED_WORDS = ["__fastcall", "__noreturn", "__cdecl", "__stdcall", "__usercall", "__extension__"]
REPLACED_WORDS = {
    "__int128": "long long", "__int64": "long long", "__int32": "int", "__int16": "short", "__int8": "char",
    "__const__": "const", "__const": "const", "__inline__": "inline", "__inline": "inline",
    "__restrict__": "restrict", "__restrict": "restrict", "__volatile__": "volatile", "__volatile": "volatile",
}
PSEUDO_TYPES = ["_QWORD", "_DWORD", "_WORD", "_BYTE", "_BOOL8", "_BOOL4", "WCHAR", "gcc_va_list", "__compar_fn_t"]
DROPPED_CALLS = ["__asm__", "__asm", "volatile", "__volatile__", "__volatile", "__attribute__", "__attribute"]

def token_pattern(own: str = "+") -> str:
    """One alternation whose matches tile any text: strings, characters, numbers, words, operators, spaces, the rest.

    ``own`` makes the loops possessive, so that long literals need no backtracking stack; without it the
    pattern suits engines that never backtrack.
    """
    return (
        rf'(?:u8|[LuU])?"(?:[^"\\\n]|\\[^\n])*{own}"'
        rf"|[LuU]?'(?:[^'\\\n]|\\[^\n])+{own}'"
        r"|0[xX][0-9a-fA-F]+[uUlL]*"
        r"|(?:[0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)(?:[eE][+-]?[0-9]+)?[uUlLfF]*"
        r"|[A-Za-z_$][0-9A-Za-z_$]*"
        r"|\.\.\.|<<=|>>=|->|\+\+|--|<<|>>|<=|>=|==|!=|&&|\|\||\*=|/=|%=|\+=|-=|&=|\|=|\^="
        r"|[ \t\n\r\f]+"
        r"|[^ \t\n\r\f]"
    )


TOKEN = token_pattern()

# A backslash and the character after it stand as one of two characters that no text may hold, so that a JSON string ends at the next quote.
_BACKSLASH, _QUOTE = "\ufdd0", "\ufdd1"
_BRACKET_PIECE = r'[{}\[\]](?:[^{}\[\]"]++|"[^"]*+")*+'


def bracket_pieces(json_text: Column) -> Column:
    """JSON cut at the brackets outside strings: each piece begins with one. Escapes are kept by ``unescaped`` only."""
    escaped = F.replace(F.replace(json_text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    return F.regexp_extract_all(escaped, F.lit(_BRACKET_PIECE), F.lit(0))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def function_name(json_line: Column) -> Column:
    """Name of the function in a raw JSON line, without decoding it; null when there is none."""
    return F.nullif(F.regexp_extract(json_line, FUNCTION_IN_JSON, 1), F.lit(""))


def decoded(json_line: Column) -> Column:
    """The line as a struct without its tree; ``_corrupt`` is set when it cannot be decoded."""
    return F.from_json(json_line, JSON_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", **JSON_OPTIONS})


def tree_of(json_line: Column) -> Column:
    """JSON text of the tree of a line that can be decoded, without white space between its parts; null when there is none.

    The line is cut at the brackets outside strings, and one pass counts the levels: the tree is what stands between the bracket after the
    name at the first level and the one that leads back to that level. It may be of any depth.
    """
    none = F.lit(None).cast("int")

    def found(pieces_: Column) -> Column:
        def step(state: Column, piece: Column) -> Column:
            level = state["level"] + F.when(F.substring(piece, 1, 1).isin("{", "["), 1).otherwise(-1)
            at = state["at"] + 1
            begin = F.coalesce(state["begin"], F.when((level == 1) & piece.rlike(r'"ast"\s*+:\s*+$'), at + 1))
            return F.struct(
                level.alias("level"), at.alias("at"), begin.alias("begin"),
                F.coalesce(state["end"], F.when((level == 1) & (state["begin"] <= at), at)).alias("end"),
            )

        start = F.struct(F.lit(0).alias("level"), F.lit(0).alias("at"), none.alias("begin"), none.alias("end"))
        return F.aggregate(pieces_, start, step)

    def cut(pieces_: Column) -> Column:
        def text(range_: Column) -> Column:
            inner = F.array_join(F.slice(pieces_, range_["begin"], range_["end"] - range_["begin"]), "")
            return F.when(range_["end"].isNotNull(), F.concat(inner, F.substring(F.element_at(pieces_, range_["end"]), 1, 1)))

        return F.transform(F.array(found(pieces_)), text)[0]

    text = F.transform(F.array(bracket_pieces(json_line)), cut)[0]
    return unescaped(F.regexp_replace(text, r'("[^"]*+")|\s++', "$1"))


def variables(code: Column) -> Column:
    """Distinct (id, decompiled name, original name) of the variables in the code."""
    def fields(match: Column) -> Column:
        parts = F.split(match, "@@")
        return F.struct(
            F.substr(F.get(parts, F.lit(1)), F.lit(5)).alias("id"), F.get(parts, F.lit(2)).alias("decompiled"),
            F.get(parts, F.lit(3)).alias("original"),
        )

    return F.array_distinct(F.transform(F.regexp_extract_all(code, F.lit(VARIABLE), F.lit(0)), fields))


def conflicting(triples: Column) -> Column:
    """Whether one id carries different names."""
    return F.size(F.array_distinct(F.transform(triples, lambda t: t["id"]))) < F.size(triples)


def safe_prefix(code: Column) -> Column:
    """Identifier prefix that the code does not contain: ``v`` and three to ten letters of its digest.

    A code that contains all of these gets a longer digest whole, which a text cannot contain but by inverting the digest.
    """
    letters = lambda digest: F.translate(digest, "0123456789abcdef", "ghijklmnopqrstuv")
    tries = [F.concat(F.lit("v"), F.substring(letters(F.md5(code)), 1, n)) for n in range(3, 11)]
    return F.coalesce(*[F.when(~F.contains(code, p), p) for p in tries], F.concat(F.lit("v"), letters(F.sha2(code, 256))))


def with_plain_variables(code: Column, prefix: Column) -> Column:
    return F.regexp_replace(code, F.lit(VARIABLE), F.concat(prefix, F.lit("_$1")))


def without_registers(code: Column) -> Column:
    return F.regexp_replace(code, REGISTER, "")


def with_full_name(code: Column, name: Column) -> Column:
    """Put back the underscore that the decompiler takes off function names."""
    short = F.concat(F.lit(r"(?<![a-zA-Z0-9_])\Q"), F.substr(name, F.lit(2)), F.lit(r"\E(?![a-zA-Z0-9_])"))
    full = F.replace(name, F.lit("$"), F.lit("\\$"))
    repaired = F.regexp_replace(code, short, full)
    return F.when(F.startswith(name, F.lit("_")) & (F.length(name) > 1), repaired).otherwise(code)


def cleaned(code: Column, prefix: Column, name: Column) -> Column:
    return with_full_name(without_registers(with_plain_variables(code, prefix)), name)


def without_line_controls(code: Column, keep_newline: bool = False) -> Column:
    return F.regexp_replace(code, LINE_CONTROL if keep_newline else LINE_CONTROL_WITH_NEWLINE, "")


def without_header(code: Column) -> Column:
    """Text after the last header marker; the whole text when there is none."""
    return F.substring_index(code, HEADER_END, -1)


def pieces(code: Column) -> Column:
    """Tokens and the spaces between them; joined they give the text again."""
    return F.regexp_extract_all(code, F.lit(TOKEN), F.lit(0))


def is_space(piece: Column) -> Column:
    return F.substring(piece, 1, 1).isin(" ", "\t", "\n", "\r", "\f")


def token_values(code: Column) -> Column:
    return F.filter(pieces(code), lambda p: ~is_space(p))


def is_word(value: Column) -> Column:
    first = F.substring(value, 1, 1)
    letter = first.between("a", "z") | first.between("A", "Z") | first.isin("_", "$")
    return letter & ~F.endswith(value, F.lit('"')) & ~F.endswith(value, F.lit("'"))


def is_identifier(value: Column) -> Column:
    return is_word(value) & ~value.isin(KEYWORDS)


def token_type(value: Column) -> Column:
    first = F.substring(value, 1, 1)
    long = F.length(value) > 1
    return (
        F.when(long & F.endswith(value, F.lit('"')), "string")
        .when(long & F.endswith(value, F.lit("'")), "char")
        .when(is_word(value), F.when(value.isin(KEYWORDS), "keyword").otherwise("id"))
        .when(first.between("0", "9") | ((first == ".") & F.substring(value, 2, 1).between("0", "9")), "number")
        .otherwise("op")
    )


def normalised(code: Column) -> Column:
    """Decompiler dialect in plain C, word by word; strings stay as they are. Macros go with their arguments, however deep these nest."""
    replacement = F.create_map(*[F.lit(x) for pair in REPLACED_WORDS.items() for x in pair])

    def word(piece: Column) -> Column:
        return F.when(piece.isin(DROPPED_WORDS), "").otherwise(F.coalesce(F.try_element_at(replacement, piece), piece))

    def end_of_call(found: Column, at: Column) -> Column:
        """Place of the parenthesis that closes the one after the word at a place; null when none follows or it stays open."""
        def step(state: Column, piece: Column) -> Column:
            level = state["level"] + F.when(piece == "(", 1).when(piece == ")", -1).otherwise(0)
            i = state["at"] + 1
            open_ = state["open"] & (is_space(piece) | (level > 0))
            return F.struct(i.alias("at"), level.alias("level"), open_.alias("open"), F.coalesce(state["end"], F.when(state["open"] & (piece == ")") & (level == 0), i)).alias("end"))

        start = F.struct(at.alias("at"), F.lit(0).alias("level"), F.lit(True).alias("open"), F.lit(None).cast("int").alias("end"))
        return F.aggregate(F.slice(found, at + 2, F.size(found)), start, step)["end"]

    def without_calls(found: Column) -> Column:
        names = F.filter(F.transform(found, lambda p, i: F.when(p.isin(DROPPED_CALLS), i)), lambda i: i.isNotNull())
        ranges = F.filter(F.transform(names, lambda i: F.struct(i.alias("first"), end_of_call(found, i).alias("last"))), lambda r: r["last"].isNotNull())

        def kept(calls: Column) -> Column:
            return F.filter(found, lambda p, i: ~F.exists(calls, lambda r: i.between(r["first"], r["last"])))

        return F.when(F.size(names) == 0, found).otherwise(F.transform(F.array(ranges), kept)[0])

    left = F.transform(F.array(pieces(code)), without_calls)[0]
    return F.array_join(F.transform(left, word), "")


def error_type(message: Column, line: Column) -> Column:
    """Type name that a parse error points to; null when it cannot be told.

    The token at the reported column must be the reported one. It is the type itself after a qualifier
    or comma, else the nearest earlier identifier is.
    """
    column = F.regexp_extract(message, r"^.*?:(\d+):(\d+): before: (.+)", 2)
    token = F.regexp_extract(message, r"^.*?:(\d+):(\d+): before: (.+)", 3)
    at = F.when(column != "", column.cast("int"))
    before, rest = pieces(line.substr(F.lit(1), at - 1)), pieces(line.substr(at, F.length(line)))
    on_token = (F.concat(before, rest) == pieces(line)) & (F.get(rest, F.lit(0)) == token)
    earlier = F.filter(before, lambda p: ~is_space(p))
    previous = F.try_element_at(earlier, F.lit(-1))
    identifier = F.try_element_at(F.filter(earlier, is_identifier), F.lit(-1))
    return F.when(on_token, F.when(F.coalesce(previous.isin(QUALIFIERS), F.lit(False)), token).otherwise(identifier))


def marked(name: Column, code: Column) -> Column:
    """Function code between its marker lines."""
    begin = F.concat(F.lit(MARKER), name, F.lit(MARKER_BEGIN))
    end = F.concat(F.lit(MARKER), name, F.lit(MARKER_END))
    return F.concat_ws("\n", F.lit(""), begin, code, end, F.lit(""))


def marked_functions(code: Column) -> Column:
    """Array of (name, text) between marker lines; of repeated markers the last counts."""
    lines = F.split(code, "\n")

    def marker(line: Column, index: Column) -> Column:
        ends = F.endswith(line, F.lit(MARKER_END))
        is_marker = F.startswith(line, F.lit(MARKER)) & (ends | F.endswith(line, F.lit(MARKER_BEGIN)))
        size = F.length(line) - len(MARKER) - F.when(ends, len(MARKER_END)).otherwise(len(MARKER_BEGIN))
        name = line.substr(F.lit(len(MARKER) + 1), size)
        return F.when(is_marker, F.struct(name.alias("name"), (~ends).alias("begin"), index.alias("at")))

    def let(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]

    def functions(lasts: Column) -> Column:
        """Ends sort before beginnings of the same name, so a function is two neighbours."""

        def function(m: Column, i: Column) -> Column:
            end = F.when(i > 0, F.get(lasts, i - 1))
            text = F.array_join(F.slice(lines, m["at"] + 2, F.greatest(end["at"] - m["at"] - 1, F.lit(0))), "\n")
            return F.when(m["begin"] & (end["name"] == m["name"]), F.struct(m["name"].alias("name"), text.alias("text")))

        return F.array_compact(F.transform(lasts, function))

    def last_of_kind(markers: Column) -> Column:
        def last(m: Column, i: Column) -> Column:
            after = F.get(markers, i + 1)
            return F.coalesce((after["name"] != m["name"]) | (after["begin"] != m["begin"]), F.lit(True))

        return F.filter(markers, last)

    markers = F.array_sort(F.array_compact(F.transform(lines, marker)))  # by name, kind and place
    return let(let(markers, last_of_kind), functions)
