"""One consistent form for texts that look the same: a confusables skeleton."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Durable

# Letters of other scripts, each above the Latin letter it looks like. Digits, case and punctuation are told
# apart by a reader, so none of them stands here. What isn't here is no look-alike; a fuller table can be read (``load``).
CYRILLIC = ("АВЕКМНОРСТХУҮЅІЈԌԚԜаеорсухѕіјһԁԛԝѵӏүгӀ", "ABEKMHOPCTXYYSIJGQWaeopcyxsijhdqwvlyrI")
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρϲϳαγισυ", "ABEZHIKMNOPTYXovpcjayiou")
ARMENIAN = ("ՍՕօոսհց", "UOonuhg")
COPTIC = ("ⲀⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "ABHIKMNOPCTYXopc")
CHEROKEE = ("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏳᏴ", "DRTiYAJEWMHYGhZbRWSVSLCPKdGB")
LISU = ("ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓪꓫꓬꓮꓰꓲꓳꓴ", "BPdDTGKJCZFMNLSRVWXYAEIOU")
LATIN = ("ɑɡᴄᴏᴠᴡᴢıɩɪȷꜱᴜʏꞌ", "agcovwziiijsuy'")
#: Kinds of hyphen and minus.
HYPHENS = "‐‑‒–⁃−˗"
#: Compatibility forms that only restyle a character; the others (superscripts, fractions, circled) read differently.
STYLES = ("<wide>", "<narrow>", "<small>", "<vertical>", "<square>", "<font>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>")

LOOK_ALIKE = {ord(a): b for pair in (CYRILLIC, GREEK, ARMENIAN, COPTIC, CHEROKEE, LISU, LATIN) for a, b in zip(*pair, strict=True) if a != b}


def load(lines: Iterable[str]) -> dict[int, str]:
    """Look-alikes of a table in the form that the Unicode confusables have: ``source ; prototype ; type`` in code points,
    ``#`` begins a comment. Only single letters that stand for single letters are taken, and only where the letter written
    on its own isn't case, width or style of the other, which are settled otherwise."""
    found = {}
    for line in lines:
        parts = [x.split() for x in line.split("#")[0].replace("\ufeff", "").split(";")]
        if len(parts) < 2 or len(parts[0]) != 1 or len(parts[1]) != 1:
            continue
        a, b = chr(int(parts[0][0], 16)), chr(int(parts[1][0], 16))
        if a.isalpha() and b.isalpha() and a != b and a.casefold() != b.casefold() and not unicodedata.decomposition(a):
            found[ord(a)] = b
    # prototypes that are look-alikes themselves are followed to their end
    return {a: next(x for x in _path(found, b) if ord(x) not in found) for a, b in found.items() if any(ord(x) not in found for x in _path(found, b))}


def _path(found: dict[int, str], start: str) -> list[str]:
    seen = [start]
    while ord(seen[-1]) in found and found[ord(seen[-1])] not in seen:
        seen.append(found[ord(seen[-1])])
    return seen


def look_alikes_of(table: DataFrame, source: str, prototype: str, most: int = 100_000) -> dict[int, str]:
    """As ``load``, of a table with a row a letter. Brought to the driver and sent to the tasks: raises beyond ``most`` rows."""
    rows = table.select(source, prototype).dropna().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many rows for a table of letters")
    return load(f"{ord(a):X} ; {ord(b):X}" for a, b in rows if len(a) == 1 and len(b) == 1)


def prototype(ch: str, look: dict[int, str] = LOOK_ALIKE) -> str:
    """What a single decomposed character is replaced by: '' for invisible ones, itself where nothing looks like it."""
    cp = ord(ch)
    if cp in look:
        return look[cp]
    if ch in HYPHENS:
        return "-"
    kind = unicodedata.category(ch)
    if kind == "Zs" or ch in "\t\v":
        return " "
    if kind == "Cf" or cp == 0x34F or 0xFE00 <= cp <= 0xFE0F or 0x180B <= cp <= 0x180D or cp in (0x115F, 0x1160, 0x3164, 0xFFA0) or 0xE0100 <= cp <= 0xE01EF:
        return ""
    form = unicodedata.decomposition(ch)
    if form.startswith(STYLES) and not form.startswith("<compat> 0020 "):
        return "".join(prototype(c, look) for x in form.split()[1:] for c in unicodedata.normalize("NFD", chr(int(x, 16))))
    return ch


class Prototypes(dict):
    """A translate table that fills itself as characters occur."""

    def __init__(self, look: dict[int, str] = LOOK_ALIKE) -> None:
        super().__init__()
        self.look = look

    def __missing__(self, cp: int) -> str:
        self[cp] = out = prototype(chr(cp), self.look)
        return out


_TABLE = Prototypes()


def skeleton(text: str, table: Prototypes = _TABLE) -> str:
    """The form that all texts which look like ``text`` share."""
    if text.isascii():
        return text.translate(table) if "\t" in text or "\v" in text else text
    return unicodedata.normalize("NFD", unicodedata.normalize("NFD", text).translate(table))


class _Folded(dict):
    """Character to the letters and digits it stands for, without case and accents; ' ' for all that separates words."""

    def __missing__(self, cp: int) -> str:
        plain = "".join(c for c in skeleton(chr(cp)).casefold() if not unicodedata.combining(c))
        self[cp] = out = "".join(c if c.isalnum() else " " for c in skeleton(unicodedata.normalize("NFD", plain)) if not unicodedata.combining(c))
        return out


FOLDED = _Folded()


def fold(text: str) -> str:
    """Words of ``text`` in the one form that comparisons of content use; characters map one by one, so offsets can be kept."""
    return text.translate(FOLDED)


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


def skeletons(df: DataFrame, key: str, text: str, with_text: bool = False, look_alikes: dict[int, str] | None = None) -> DataFrame:
    """``key, skeleton_hash, text_hash BINARY`` (sha256) of every row, and ``skeleton`` on request. NULL texts are left out."""
    ddl = f"`{key}` {df.schema[key].dataType.simpleString()}, skeleton_hash binary, text_hash binary" + ", skeleton string" * with_text

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _TABLE if look_alikes is None else Prototypes(look_alikes)
        for b in it:
            texts = b.column(1).to_pylist()
            forms = [skeleton(t, table) for t in texts]
            cols = [b.column(0), pa.array([_digest(s) for s in forms], pa.binary()), pa.array([_digest(t) for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays([*cols, *([pa.array(forms)] * with_text)], names=[key, "skeleton_hash", "text_hash", *["skeleton"] * with_text])

    return df.select(F.col(key), F.col(text)).dropna().mapInArrow(run, ddl)


#: Rows of one text that meet one row of a twin text in a task, at most about so many.
COPIES_A_TASK = 1000


def twin_classes(df: DataFrame, key: str, text: str, look_alikes: dict[int, str] | None = None) -> DataFrame:
    """Membership of every row whose text has a twin: ``key, class_id`` (smallest key of the rows that read the same),
    ``form_id`` (smallest key of the rows with just this text), ``n_forms, n_copies``.

    Rows of a class with other ``form_id`` are twins; so every link is there without a row a pair. Texts travel as hashes;
    sizes and smallest keys combine before they shuffle. Edge cases as for ``twins``.
    """
    rows = Durable(df.sparkSession).keep(skeletons(df, key, text, look_alikes=look_alikes).distinct())
    forms = rows.groupBy("skeleton_hash", "text_hash").agg(F.min(key).alias("form_id"), F.count(F.lit(1)).alias("n_copies"))
    classes = forms.groupBy("skeleton_hash").agg(F.min("form_id").alias("class_id"), F.count(F.lit(1)).alias("n_forms")).filter("n_forms > 1")
    return rows.join(forms.join(classes, "skeleton_hash"), ["skeleton_hash", "text_hash"]).select(key, "class_id", "form_id", "n_forms", "n_copies")


def twins(df: DataFrame, key: str, text: str, look_alikes: dict[int, str] | None = None) -> DataFrame:
    """Every two rows whose texts differ in code points and share a skeleton: ``key_a, key_b``, smaller key first.

    Texts travel as hashes only. Classes with a single text are dropped by a minimum and a maximum, which combine before the
    shuffle; the distinct texts of the others are paired, then their rows, so rows of one text never meet each other. The
    rows of a text with many copies are dealt out over parts of COPIES_A_TASK, and each part meets the other text's rows on
    its own, so no task has all pairs of two much copied texts. ``twin_classes`` gives the same links without a row a pair.

    NULL keys or texts are left out; empty texts only equal those that are invisible; a repeated row counts once; an empty
    table gives an empty result; other columns are ignored.
    """
    rows = Durable(df.sparkSession).keep(skeletons(df, key, text, look_alikes=look_alikes))  # read four times below
    mixed = rows.groupBy("skeleton_hash").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b")).filter("a <> b").select("skeleton_hash")
    members = rows.join(mixed, "skeleton_hash").distinct()
    forms = members.groupBy("skeleton_hash", "text_hash").agg(F.ceil(F.count(F.lit(1)) / F.lit(COPIES_A_TASK)).alias("parts"))
    a, b = forms.select("skeleton_hash", F.col("text_hash").alias("t1")), forms.select("skeleton_hash", F.col("text_hash").alias("t2"), "parts")
    pairs = a.join(b, "skeleton_hash").filter("t1 < t2").select("t1", "t2", "parts", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    left = members.select(F.col("text_hash").alias("t1"), F.col(key).alias("x"))
    right = members.join(forms.select("text_hash", "parts"), "text_hash").select(F.col("text_hash").alias("t2"), F.col(key).alias("y"), F.pmod(F.xxhash64(key), F.col("parts")).alias("part"))
    return pairs.join(left, "t1").join(right, ["t2", "part"]).select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).filter("key_a < key_b").distinct()


def canonical(df: DataFrame, key: str, text: str, look_alikes: dict[int, str] | None = None) -> DataFrame:
    """One row a document: its consistent form, the smallest key of the documents that read the same, how many texts they have."""
    rows = Durable(df.sparkSession).keep(skeletons(df, key, text, with_text=True, look_alikes=look_alikes))
    classes = rows.groupBy("skeleton_hash").agg(F.min(key).alias("class_id"), F.count_distinct("text_hash").alias("n_forms"), F.count(F.lit(1)).alias("n_documents"))
    return rows.join(classes, "skeleton_hash").select(key, F.col("skeleton").alias("canonical_text"), "class_id", "n_forms", "n_documents")
