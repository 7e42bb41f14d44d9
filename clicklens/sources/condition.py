"""The conditions a batch run is asked for."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

CONDITION_PROPERTY = "condition.params.json"


@dataclass(frozen=True)
class Condition:
    """Bounds on the action log; an empty text, ``None`` or age 0 is no bound.

    The comma-joined lists (``professionals`` to ``categoryIds``) are only
    looked at when a report is asked to, see ``operators.filters``.
    """

    startDate: str = ""
    endDate: str = ""
    startAge: int = 0
    endAge: int = 0
    professionals: str = ""
    city: str = ""
    gender: str = ""
    keywords: str = ""
    categoryIds: str = ""
    targetPageFlow: str = ""

    @classmethod
    def from_dict(cls, values: Mapping[str, object]) -> Condition:
        """Ages may be text ("20"); ``cities`` is another name of ``city``."""
        values = {("city" if name == "cities" else name): value for name, value in values.items()}
        if unknown := values.keys() - {field.name for field in fields(cls)}:
            raise ValueError(f"a condition has no {', '.join(sorted(unknown))}")
        known = {}
        for field in fields(cls):
            value = values.get(field.name)
            if field.name in ("startAge", "endAge"):
                known[field.name] = int(value or 0)
            else:
                known[field.name] = "" if value is None else str(value)
        return cls(**known)

    @classmethod
    def from_json(cls, text: str) -> Condition:
        return cls.from_dict(json.loads(text))

    @classmethod
    def from_file(cls, spark: SparkSession, path: str) -> Condition:
        """Read one JSON object, whose names need not be quoted, from any file system."""
        row = (
            spark.read
            .options(multiLine=True, allowUnquotedFieldNames=True, primitivesAsString=True,
                     mode="FAILFAST")
            .json(path)
            .first()
        )
        return cls.from_dict(row.asDict())

    @classmethod
    def from_properties(
        cls, spark: SparkSession, path: str, name: str = CONDITION_PROPERTY
    ) -> Condition:
        """Read a Java properties file whose value ``name`` is the JSON object, see ``from_file``."""
        text = spark.read.text(path, wholetext=True).first().value
        properties = spark._jvm.java.util.Properties()
        properties.load(spark._jvm.java.io.StringReader(text))
        value = properties.getProperty(name)
        if value is None:
            raise ValueError(f"{path} has no {name}")
        options = {"allowUnquotedFieldNames": "true", "mode": "FAILFAST"}
        found = F.from_json(F.lit(value), "map<string, string>", options)
        return cls.from_dict(spark.range(1).select(found.alias("found")).first().found)
