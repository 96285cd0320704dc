"""Functions on residues, elements and chemical components."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxelforge.functions import fixed as X


def _lookup(table: dict, c: Column) -> Column:
    return F.create_map(*[F.lit(v) for v in chain(*table.items())])[c]


def token_residue(comp: Column) -> Column:
    """The parent residue that a residue class is taken from."""
    name = F.upper(F.trim(comp))
    return F.coalesce(_lookup(X.TOKEN_PARENTS, name), name)


def feature_residue(comp: Column) -> Column:
    """The parent residue that features are taken from."""
    name = F.upper(F.trim(comp))
    return F.coalesce(_lookup(X.FEATURE_PARENTS, name), name)


def residue_class(comp: Column) -> Column:
    """0 to 28, the last for anything unknown."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(r) for r in X.RESIDUE_CLASSES]), token_residue(comp)), F.lit(0)) - 1, F.lit(28)).cast("int")


def is_backbone(comp: Column, atom: Column) -> Column:
    """Whether the atom is of the main chain, by the residue's kind."""
    return F.when(token_residue(comp).isin(X.NUCLEOTIDES), atom.isin(X.NUCLEIC_BACKBONE)).otherwise(atom.isin(X.PROTEIN_BACKBONE))


def type_tag(branched: Column, n_atoms: Column, element: Column, comp_types: Column) -> Column:
    """The kind of an occurrence. comp_types is an array of component types; element is that of a single atom."""
    types = F.transform(comp_types, F.upper)
    some = F.size(types) > 0
    return (
        F.when(branched, "sugar")
        .when(some & F.forall(types, lambda t: F.contains(t, F.lit("SACCHARIDE"))), "sugar")
        .when(F.exists(types, lambda t: F.contains(t, F.lit("PEPTIDE LINKING"))), "peptide_like")
        .when(F.exists(types, lambda t: F.contains(t, F.lit("NA LINKING"))), "nucleotide_like")
        .when((n_atoms == 1) & element.isin(X.METALS), "ion")
        .when(some & F.forall(types, lambda t: t == "NON-POLYMER"), "small_molecule")
        .otherwise("other")
    )


def one_hot(code: Column, size: int) -> Column:
    """`size` booleans, that of the code true; a code outside takes the last."""
    at = F.when((code >= 0) & (code < size), code).otherwise(size - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: i == at)


def vdw_radius(atomic_number: Column, more: dict[int, float] | None = None) -> Column:
    """The radius of an element; `more` holds elements beyond the fixed ones. One that neither has raises when read."""
    found = _lookup(X.VDW_RADII | {k: v for k, v in (more or {}).items() if k not in X.VDW_RADII}, atomic_number)
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no radius for element "), F.coalesce(atomic_number.cast("string"), F.lit("null")))).cast("double"))


def features(element: Column, comp: Column, shells: Column) -> Column:
    """The 49 numbers of a receptor atom: 6 element, 25 residue, 8 physico-chemical, mass, 9 of log1p(shells)."""
    flag = lambda x: x.cast("float")
    residue = feature_residue(comp)
    elements = [flag(element == e) for e in X.FEATURE_ELEMENTS] + [flag(~element.isin(X.FEATURE_ELEMENTS))]
    residues = [flag(residue == r) for r in X.FEATURE_RESIDUES] + [flag(~residue.isin(X.FEATURE_RESIDUES))]
    known = {k: F.array(*[F.lit(v).cast("float") for v in row]) for k, row in X.PHYSICO_CHEMICAL.items()}
    table = F.create_map(*[c for k, row in known.items() for c in (F.lit(k), row)])
    physico = F.coalesce(F.try_element_at(table, residue), known["UNK"])
    mass = (F.coalesce(_lookup(X.MASSES, element), F.lit(X.OTHER_MASS)) / X.MASS_UNIT).cast("float")
    return F.concat(F.array(*elements, *residues), physico, F.array(mass), F.transform(shells, lambda n: F.log1p(n.cast("double")).cast("float")))


def is_finite(c: Column) -> Column:
    """Neither null nor NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def is_positive(c: Column) -> Column:
    """Finite and above zero."""
    return is_finite(c) & (c > 0)


def failure_kind(code: Column) -> Column:
    """known, tool, or other for anything else."""
    return F.when(code.isin(X.KNOWN_FAILURES), "known").when(code.isin(X.TOOL_FAILURES), "tool").otherwise("other")


def nan_equal(a: Column, b: Column) -> Column:
    """Whether two numbers are the same, two NaN or two nulls too."""
    return a.eqNullSafe(b)
