"""Physical-plan building blocks shared by the operators: size-checked joins,
exact row numbers over skewed groups, reliable lineage cuts."""

from .joins import fits_broadcast, lookup_join
from .lineage_cut import cut_lineage, cuts_in, drop_cut
from .numbering import Slicing, number_rows, slice_groups
from .shipping import ship

__all__ = ["Slicing", "cut_lineage", "cuts_in", "drop_cut", "fits_broadcast", "lookup_join", "number_rows", "ship", "slice_groups"]
