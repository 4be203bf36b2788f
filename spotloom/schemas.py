"""Explicit schemas of every input."""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


POSITIONS = _struct(
    barcode=_S, in_tissue=_I, array_row=_I, array_col=_I, pxl_row_in_fullres=_I, pxl_col_in_fullres=_I
)
EXPRESSION = _struct(barcode=_S, gene=_S, count=_L)
FEATURES = _struct(id=_S, name=_S, feature_type=_S)
PARAMETERS = _struct(name=_S, value=_S)
CLUSTERS = _struct(barcode=_S, cluster=_S)
PIXELS = _struct(y=_I, x=_I, inst_id=_L)
POINT = _struct(x=_D, y=_D)

_RING = T.ArrayType(T.ArrayType(_D))
FEATURE = _struct(
    properties=_struct(name=_S, classification=_struct(name=_S)),
    geometry=_struct(type=_S, coordinates=T.ArrayType(_RING)),
)

NUCLEUS = _struct(
    bbox=T.ArrayType(T.ArrayType(_I)),
    centroid=T.ArrayType(_D),
    contour=T.ArrayType(T.ArrayType(_I)),
    type_prob=_D,
    type=_I,
)
NUCLEI = _struct(mag=_D, nuc=T.MapType(_S, NUCLEUS))


def columns_of_role(columns: list[str], cell_types: list[str]) -> dict[str, list[str]]:
    """Roles of the columns of a wide table: qc, cell types, genes, other."""
    from .operators.genes import analysis_genes

    genes = analysis_genes(columns, cell_types)
    roles: dict[str, list[str]] = {"qc": [], "cell_type": [], "gene": genes, "other": []}
    for c in columns:
        if c in genes:
            continue
        role = "qc" if "qc_" in c else "cell_type" if c in cell_types else "other"
        roles[role].append(c)
    return roles
