"""Lexical measures of strings. Null in, null out."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The extensions the file-name test looks for.
FILE_EXTENSIONS = """
    doc docx odt pages rtf txt wpd wps
    csv numbers ods xls xlsx
    asp aspx css htm html jsp php xml
    afdesign ai cad cdr drw dwg eps odg svg vsdx
    afpub indd pdf pdfxml pmd pub qxp
    c cpp cs java js json py sql swift vb
    7z rar tar tar.gz zip
    bak cfg conf ini msi sys tmp
    app bat bin cmd com exe vbs x86
""".split()

# Fixed value: entropy below this counts as human readable.
READABLE_BELOW = 3.0

# The code points a line is stripped of at both ends.
BLANKS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove blanks of any kind at both ends."""
    return F.btrim(_col(c), F.lit(BLANKS))


def char_count(c, char: str) -> Column:
    """How often the one-character string ``char`` occurs."""
    c = _col(c)
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def capital_count(c) -> Column:
    """How many characters are upper case, letters outside the Lu category included."""
    return F.regexp_count(_col(c), F.lit(r"\p{IsUppercase}"))


def _shortest(words: list[str]) -> list[str]:
    """Words that contain no other word of the list; a text holds one of these iff it holds any."""
    return [w for w in words if not any(o != w and o in w for o in words)]


def has_file_extension(c, mode: str = "substring") -> Column:
    """1 if the lower-cased text holds one of ``FILE_EXTENSIONS``, else 0.

    ``substring`` accepts an extension anywhere in the text; ``suffix`` only after the last dots.
    """
    if mode == "substring":
        words = _shortest(FILE_EXTENSIONS)
        # The look-ahead passes over characters that begin no word.
        firsts = "".join(sorted({w[0] for w in words}))
        pattern = f"(?=[{firsts}])(?:" + "|".join(w.replace(".", r"\.") for w in words) + ")"
    elif mode == "suffix":
        pattern = r"\.(?:" + "|".join(w.replace(".", r"\.") for w in FILE_EXTENSIONS) + ")$"
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.lower(_col(c)).rlike(pattern).cast("int")


def entropy(c) -> Column:
    """Shannon entropy in bits per character; 0 for the empty text.

    The characters are sorted, and each run of equal ones is taken by one match over the sorted text: the work is that
    of sorting, whatever the alphabet.
    """
    c = _col(c)
    size = F.length(c)
    ordered = F.array_join(F.sort_array(F.split(c, "")), "")
    runs = F.regexp_extract_all(ordered, F.lit(r"(?s)(.)\1*"), F.lit(0))
    # Added up run by run, in one order for equal sets of characters.
    bits = F.aggregate(
        F.transform(runs, lambda run: F.length(run) / size), F.lit(0.0), lambda total, p: total - p * F.log2(p)
    )
    return F.when(size == 0, F.lit(0.0)).otherwise(bits)


def is_readable(entropy_value, threshold: float = READABLE_BELOW) -> Column:
    """1 if the entropy is strictly below the threshold, else 0."""
    return (_col(entropy_value) < threshold).cast("int")
