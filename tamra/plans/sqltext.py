"""SQL fragments shared by the comparison queries (DuckDB dialect)."""

WORD = r"[\p{L}\p{M}\p{N}]+"
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(text: str = "text") -> str:
    return f"regexp_extract_all(lower({text}), {quote(WORD)})"


def tokens(text: str = "text") -> str:
    return f"regexp_extract_all({text}, {quote(TOKEN)})"


def grams(items: str, n: int) -> str:
    """Neighbouring items zipped, so that no lambda carries the whole list."""
    if n == 1:
        return items
    shifted = ", ".join([items, *[f"({items})[{i}:]" for i in range(2, n + 1)]])
    return f"list_transform(list_zip({shifted}, true), lambda s: concat_ws(' ', {', '.join(f's[{i}]' for i in range(1, n + 1))}))"


def matches(pattern: str, text: str = "text") -> str:
    return f"len(regexp_extract_all({text}, {quote(pattern)}))"


def collapse(text: str = "text") -> str:
    return f"trim(regexp_replace(lower({text}), '\\s+', ' ', 'g'))"


def hash32(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def replace_all(expression: str, rules) -> str:
    for pattern, replacement in rules:
        expression = f"regexp_replace({expression}, {quote(pattern)}, {quote(replacement)}, 'g')"
    return expression
