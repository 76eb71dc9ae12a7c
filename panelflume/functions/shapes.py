"""Result types of the Arrow kernels."""
from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType

KINDS = {"double": DoubleType(), "doubles": ArrayType(DoubleType()), "int": IntegerType(), "bool": BooleanType()}


def record(**fields: str) -> StructType:
    return StructType([StructField(name, KINDS[kind]) for name, kind in fields.items()])
