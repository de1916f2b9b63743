"""String functions as column expressions: normalised names and values, line ids, lists and name checks."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What becomes an underscore, in this order, and the letters that lose their accent even where nothing does.
TO_UNDERSCORE = ("(", ")", "*", " ", ":", ".", "-", ";", "<", "?", "/", ",", "'", "____", "___", "__")
ACCENTED, PLAIN = "áéíóúýàèìòùäëïöüÿâêîôûãõ@", "aeiouyaeiouaeiouyaeiouaoa"
_LONGER = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ĳ": "ij", "ŋ": "ng", "ŉ": "'n"}
_SINGLE = {"ø": "o", "đ": "d", "ð": "d", "ħ": "h", "ı": "i", "ł": "l", "ŧ": "t", "ĸ": "k", "ŀ": "l", "ſ": "s"}


def _ascii_map() -> dict[str, str]:
    """Lower-case Latin-1 and Latin Extended-A letters to ASCII letters: the decomposition without its marks, or the few without one."""
    out = {}
    for c in map(chr, range(0xAA, 0x180)):
        bare = unicodedata.normalize("NFKD", c)[0]
        if c == c.lower() and unicodedata.category(c)[0] in "LN" and bare != c and bare.isascii():
            out[c] = bare
    return {k: v for k, v in (out | _SINGLE).items() if k not in _LONGER}


ASCII = _ascii_map()


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_marks(c: Column | str) -> Column:
    """The short list of accented letters, and @, to plain letters (ñ and ç stay); null is the text ``None``."""
    return F.translate(F.coalesce(_col(c).cast("string"), F.lit("None")), ACCENTED, PLAIN)


def to_ascii(c: Column | str) -> Column:
    out = F.translate(_col(c), "".join(ASCII), "".join(ASCII.values()))
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), _LONGER.items(), out)


def normalise(c: Column | str) -> Column:
    """Lower case, ASCII, separators to underscores, one trailing underscore dropped. A text with nothing that becomes an underscore is only lower-cased: its accents stay. Null stays null."""
    low = F.lower(_col(c))
    # single marks and letters in one pass, then the few longer ones in their order; a mark never comes of a longer letter but ŉ
    single = "".join(m for m in TO_UNDERSCORE if len(m) == 1)
    ascii_ = F.translate(low, "".join(ASCII) + single, "".join(ASCII.values()) + "_" * len(single))
    longer = [*((k, v.translate(str.maketrans(single, "_" * len(single)))) for k, v in _LONGER.items()), *((m, "_") for m in TO_UNDERSCORE if len(m) > 1)]
    joined = reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), longer, ascii_)
    # one value of the whole chain, used twice
    return F.transform(F.array(F.struct(joined.alias("j"), low.alias("low"))), lambda x: F.when(F.contains(x.j, F.lit("_")), F.translate(F.regexp_replace(x.j, "_$", ""), ACCENTED, PLAIN)).otherwise(x.low))[0]


def standardise(c: Column | str) -> Column:
    """``normalise``, then ``strip_marks``: the form of values and names."""
    return strip_marks(normalise(c))


def standardise_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: standardise(F.col(f"`{c}`")) for c in cols})


def normalise_name(name: str) -> str:
    """``normalise`` of one Python string, for column names."""
    low = name.lower()
    out = "".join(_LONGER.get(c, ASCII.get(c, c)) for c in low)
    for mark in TO_UNDERSCORE:
        out = out.replace(mark, "_")
    if "_" not in out:
        return low
    return out.removesuffix("_").translate(str.maketrans(ACCENTED, PLAIN))


def standardise_name(name: str) -> str:
    return normalise_name(name).translate(str.maketrans(ACCENTED, PLAIN))


def standardise_names(df: DataFrame) -> DataFrame:
    """All column names in their standard form; names may then be equal, see ``merge_same_names``."""
    return df.toDF(*map(standardise_name, df.columns))


def line_id(c: Column | str, separator: str = "-") -> Column:
    """``A B - C`` to ``ab-c``: each part without spaces, standardised."""
    parts = F.split(_col(c), "\\Q" + separator + "\\E")
    return F.array_join(F.transform(parts, lambda p: standardise(F.replace(p, F.lit(" "), F.lit("")))), separator)


def has_comma(c: Column | str) -> Column:
    return F.coalesce(F.contains(_col(c), F.lit(",")), F.lit(False))


def has_outer_space(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(r"^\s|\s$"), F.lit(False))


def valve_position(c: Column | str) -> Column:
    """The number before the first underscore; null where there is none."""
    return F.split(_col(c).cast("string"), "_")[0].try_cast("double")


def diameter(c: Column | str) -> Column:
    """A number, or a fraction such as 1/2, in the first three characters without spaces; else null. Data is never evaluated as code."""
    head = F.substring(F.replace(_col(c).cast("string"), F.lit(" "), F.lit("")), 1, 3)
    below = F.split(head, "/")[1].try_cast("double")
    plain = F.when(head.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), head.try_cast("double"))
    return F.when(head.rlike(r"^\d/\d$") & (below != 0), F.split(head, "/")[0].try_cast("double") / below).otherwise(plain)


def list_of_features(c: Column | str) -> Column:
    """``['a', 'b']`` as written by Python to an array."""
    return F.transform(F.split(F.translate(_col(c), "[]'", ""), ","), lambda x: F.trim(x))


def list_of_names(c: Column | str) -> Column:
    """A comma list to an array without empty entries; null is an empty array."""
    return F.filter(F.transform(F.split(F.coalesce(_col(c), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def joined_names(c: Column | str) -> Column:
    return F.array_join(_col(c), ", ")


def apply_columns(df: DataFrame, cols: Iterable[str], f: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: f(F.col(f"`{c}`")) for c in cols})
