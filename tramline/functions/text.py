"""Text columns: station names, categories, fees, descriptions, request texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the city feeds.
NO_INFORMATION = "정보없음"
FESTIVAL = "축제"
FREE = "무료"
PAID = "유료"
STATION_SUFFIX = "역"
REQUEST_ROLE = "너는 텍스트 정리 전문가야"
REQUEST_TEMPLATE = """\
The following text is the result of parsing specific tags from an HTML page.
- Please do not add any new information; only use the content provided.
- Summarize the content in Korean, within around 1000 characters, with a clear beginning, development, turn, and conclusion.
- Present the summary in a cheerful and light tone.
- Be sure to use polite **respectful** language.

{text}"""

# Java's \s covers ASCII only, so the other Unicode white space is named beside it.
BLANK = r"[\s\p{Z}\x1c-\x1f\x{85}]"


def stripped(text: Column) -> Column:
    """Text without leading and trailing white space, Unicode separators included."""
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+$", "")


def station_name(name: Column, suffix: str = STATION_SUFFIX) -> Column:
    """Drop what lies between the first and the last parenthesis; end on ``suffix``."""
    bare = F.regexp_replace(name, rf"{BLANK}*\([^\n]*\)", "")
    return F.when(bare.endswith(suffix), bare).otherwise(F.concat(bare, F.lit(suffix)))


def contains(text: Column, part: str) -> Column:
    """Substring test that is false, not null, on null text."""
    return F.coalesce(text.contains(part), F.lit(False))


def free_flag(fee: Column, free: str = FREE, paid: str = PAID) -> Column:
    """Free → true, paid → false, anything else → null."""
    return F.when(fee == free, F.lit(True)).when(fee == paid, F.lit(False))


def collapse_category(category: Column, word: str = FESTIVAL) -> Column:
    """Every category that mentions ``word`` becomes ``word``; others stay."""
    return F.when(contains(category, word), F.lit(word)).otherwise(category)


def pick_description(first: Column, second: Column, missing: str = NO_INFORMATION) -> Column:
    """The text with more characters once stripped, the first on a tie.

    A blank or absent pair gives ``missing``. The chosen text itself is not stripped.
    """
    first_len = F.coalesce(F.length(stripped(first)), F.lit(0))
    second_len = F.coalesce(F.length(stripped(second)), F.lit(0))
    return (
        F.when(F.greatest(first_len, second_len) == 0, F.lit(missing))
        .when(first_len >= second_len, first)
        .otherwise(second)
    )


def request_text(text: Column, template: str = REQUEST_TEMPLATE) -> Column:
    """``template`` with the whole ``text`` in place of its ``{text}`` slot."""
    before, after = template.split("{text}")
    return F.concat(F.lit(before), text, F.lit(after))
