"""Scalar functions on strings, hashes and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_value(c: Column) -> Column:
    """A raw table value: a missing one, '.' and '?' as '', and one pair of matching quotes taken off."""
    bare = F.when(c.isNull() | c.isin(".", "?"), "").otherwise(c)
    quoted = (F.length(bare) >= 2) & F.substr(bare, F.lit(1), F.lit(1)).isin("'", '"') & (F.substr(bare, F.lit(1), F.lit(1)) == F.substr(bare, F.lit(-1), F.lit(1)))
    return F.when(quoted, F.substr(bare, F.lit(2), F.length(bare) - 2)).otherwise(bare)


def safe_file_name(c: Column) -> Column:
    """Every run of characters other than letters, digits, _ . - as one underscore."""
    return F.regexp_replace(c, r"[^A-Za-z0-9_.-]+", "_")


def object_key(components: Column, bonds: Column) -> Column:
    """CCD:X for one component; else BRANCHED:a-b: and six digits of the MD5 of the bonds as JSON.

    components is an array of names. bonds is an array of (res_i, atom_i, res_j,
    atom_j), sorted here; the JSON has a space after commas.
    """
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    said = F.transform(F.sort_array(bonds), lambda b: F.concat(F.lit("["), F.concat_ws(", ", b["res_i"], quoted(b["atom_i"]), b["res_j"], quoted(b["atom_j"])), F.lit("]")))
    body = F.concat(F.lit("["), F.array_join(said, ", "), F.lit("]"))
    return F.when(F.size(components) == 1, F.concat(F.lit("CCD:"), components[0])).otherwise(
        F.concat(F.lit("BRANCHED:"), F.array_join(components, "-"), F.lit(":"), F.substr(F.md5(body), F.lit(1), F.lit(6)))
    )


#: Fixed value: what an object key looks like.
OBJECT_KEY = r"^(?:CCD:[A-Z0-9]{1,8}|BRANCHED:[A-Z0-9]{1,8}(?:-[A-Z0-9]{1,8})+:[0-9a-f]{6})$"


def is_object_key(c: Column) -> Column:
    """Whether the string is a key of a ligand object."""
    return F.coalesce(c.rlike(OBJECT_KEY), F.lit(False))


def atom_name_codes(c: Column) -> Column:
    """Four numbers, a character's ASCII code less 32, zeros after the name; null for a longer name."""
    codes = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.greatest(F.ascii(F.substr(c, i, F.lit(1))) - 32, F.lit(0)))
    return F.when(F.length(c) <= 4, codes)


def residue_key(asym: Column, comp: Column, label_seq: Column, auth_seq: Column, icode: Column) -> Column:
    """(asym, comp, seq, icode) with the author's number where there is no other."""
    seq = F.coalesce(F.nullif(label_seq, F.lit("")), auth_seq, F.lit(""))
    return F.struct(asym.alias("asym"), comp.alias("comp"), seq.alias("seq"), F.coalesce(icode, F.lit("")).alias("icode"))


def undirected(a: Column, b: Column) -> Column:
    """An edge with the smaller end first."""
    return F.struct(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"))


def elapsed_seconds(c: Column) -> Column:
    """Seconds of [days-]HH:MM:SS, null where it isn't one or minutes or seconds are 60 or more."""
    p = r"^(?:(\d+)-)?(\d+):(\d{2}):(\d{2})$"
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(c, p, i), F.lit("")).cast("long"), F.lit(0))
    ok = c.rlike(p) & (part(3) < 60) & (part(4) < 60)
    return F.when(ok, part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4))


def aware_time(c: Column) -> Column:
    """An instant of ISO text with an offset; null without one."""
    return F.when(c.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(c))


def is_run_id(c: Column) -> Column:
    """A run's name: letters, digits, _ . - and not only dots."""
    return c.rlike(r"^[A-Za-z0-9_.-]+$") & ~c.rlike(r"^\.+$")


def is_sha256(c: Column) -> Column:
    """64 lowercase hex digits."""
    return c.rlike(r"^[0-9a-f]{64}$")


def path_in_scope(c: Column) -> Column:
    """A relative path that stays below its root."""
    return (F.length(c) > 0) & ~c.startswith("/") & ~F.array_contains(F.split(c, "/"), "..")


def sha256(c: Column) -> Column:
    """Lowercase hex of a string's UTF-8 bytes or of binary."""
    return F.sha2(c, 256)


def manifest_sha256(names: Column, hashes: Column) -> Column:
    """Digest of (name, hash) pairs sorted by name, as compact JSON with sorted keys."""
    rows = F.transform(F.sort_array(F.arrays_zip(names.alias("n"), hashes.alias("h"))), lambda x: F.concat(F.lit('"'), x["n"], F.lit('":"'), x["h"], F.lit('"')))
    return F.sha2(F.concat(F.lit("{"), F.array_join(rows, ","), F.lit("}")), 256)


#: What makes a tool's log fatal, and the one sequence that doesn't.
FATAL = [r"(?i)Traceback \(most recent call last\)", r"(?i)No such file", r"(?i)open failed", r"(?i)No atoms", r"(?m)(?:^|\n)\s*(?:ERROR|Error)(?::|\s)"]
BENIGN = r"""(?m)^\s*Error processing trigger "monitor changes":\s*\r?\n\s*KeyError: ['"]\?['"]\s*(?=\r?\n|$)"""


def fatal_matches(log: Column) -> Column:
    """The fatal patterns' numbers in a log, after its benign sequence is taken out."""
    rest = F.regexp_replace(log, BENIGN, "")
    return F.array_compact(F.array(*[F.when(rest.rlike(p), i) for i, p in enumerate(FATAL)]))


#: Fixed value: how a tool writes a number.
NUMBER = r"[-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?"


def correlations(log: Column, begin: str, end: str) -> Column:
    """(plain, about_mean) between two markers that occur once each, each value once; else null."""
    once = (F.size(F.split(log, begin, -1)) == 2) & (F.size(F.split(log, end, -1)) == 2)
    body = F.get(F.split(F.get(F.split(log, begin, -1), F.lit(1)), end, -1), F.lit(0))
    plain = F.regexp_extract_all(body, F.lit(rf"(?i)(?<!about mean )correlation\s*=\s*({NUMBER})"), 1)
    mean = F.regexp_extract_all(body, F.lit(rf"(?i)correlation about mean\s*=\s*({NUMBER})"), 1)
    one = once & (F.size(plain) == 1) & (F.size(mean) == 1)
    return F.when(one, F.struct(F.get(plain, F.lit(0)).cast("double").alias("plain"), F.get(mean, F.lit(0)).cast("double").alias("about_mean")))


def transient_type(name: Column) -> Column:
    """cif_tmp and its like for a file that is being written, cif and its like for an intermediate, else null."""
    low = F.lower(name)
    tmp = F.regexp_extract(low, r"\.(cif|map|mrc)\.tmp\.", 1)
    own = F.regexp_extract(low, r"\.(cif|map|mrc)$", 1)
    return F.when(tmp != "", F.concat(tmp, F.lit("_tmp"))).when(own != "", own)


def quoted_path(path: str) -> str:
    """An absolute path in double quotes for a tool's command line."""
    if any(c in path for c in '"\n\r'):
        raise ValueError(f"unsupported path: {path!r}")
    return f'"{path}"'
