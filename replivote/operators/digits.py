"""Several criteria as the digits of one number."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: For each criterion, the words that its digits from 1 on stand for.
CodeBook = Mapping[str, Sequence[str]]


def places(book: CodeBook) -> dict[str, tuple[int, int]]:
    """Per criterion the value of its lowest digit and how many numbers fit: 10, or 100 for more than 9 words, and so on.

    The first criterion has the highest digits. A word may stand in a criterion once; all
    criteria together must fit into 18 digits.
    """
    found, unit = {}, 1
    for name, words in reversed(book.items()):
        if len(set(words)) < len(words):
            raise ValueError(f"a word stands twice under {name!r}")
        room = 10 ** len(str(len(words)))
        found[name] = (unit, room)
        unit *= room
    if unit > 10**18:
        raise ValueError("these criteria do not fit into one number")
    return dict(reversed(found.items()))


def digits(book: CodeBook) -> tuple[Column, Column]:
    """The number of a row whose columns are named like the criteria, and the criteria whose word is not in the book.

    A word that is null or not in the book is digit 0; only the latter is reported.
    """
    number, unknown = F.lit(0).cast("long"), []
    for name, (unit, _) in places(book).items():
        # a list search keeps the expression short however many words there are
        digit = F.coalesce(F.array_position(F.array(*[F.lit(w) for w in book[name]]), F.col(name)), F.lit(0)) if book[name] else F.lit(0)
        number = number + digit.cast("long") * F.lit(unit)
        unknown.append(F.when((digit == 0) & F.col(name).isNotNull(), F.lit(name)))
    return number, F.array_compact(F.array(*unknown)) if unknown else F.array().cast("array<string>")


def with_digits(rows: DataFrame, book: CodeBook) -> DataFrame:
    """``rows`` with ``code`` and ``unknown``; input columns of these names are replaced."""
    number, unknown = digits(book)
    return rows.withColumns({"code": number, "unknown": unknown})


def decoded(rows: DataFrame, book: CodeBook, code: str = "code") -> DataFrame:
    """``rows`` with a column per criterion: the word of its digits, null for 0 or digits without a word."""
    columns = {}
    for name, (unit, room) in places(book).items():
        digit = F.expr(f"`{code}` div {unit}") % F.lit(room)
        words = F.array(*[F.lit(w) for w in book[name]]) if book[name] else F.array().cast("array<string>")
        columns[name] = F.when(digit > 0, F.get(words, digit.cast("int") - 1))
    return rows.withColumns(columns)
