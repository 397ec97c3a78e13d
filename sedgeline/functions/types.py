"""Value types: maps of the source formats, unions, and the registry of all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

XSD = "http://www.w3.org/2001/XMLSchema#"

# Which source types stand for which target type.
XSD_TYPES = {
    "String": "string anyURI normalizedString token language Name NCName NMTOKEN time duration dayTimeDuration yearMonthDuration base64Binary hexBinary QName NOTATION".split(),
    "Boolean": ["boolean"],
    "DateTime": "dateTime date dateTimeStamp".split(),
    "BigInt": "integer int long short byte nonNegativeInteger positiveInteger nonPositiveInteger negativeInteger unsignedInt unsignedLong unsignedShort unsignedByte".split(),
    "Double": "double float decimal".split(),
}
DTDL_TYPES = {
    "Boolean": ["boolean"],
    "BigInt": "byte short integer long unsignedByte unsignedShort unsignedInteger unsignedLong".split(),
    "Double": "float double decimal".split(),
    "String": "string uuid bytes time duration point lineString polygon multiPoint multiLineString multiPolygon scaledDecimal".split(),
    "DateTime": "date dateTime".split(),
}
CDM_PRIMITIVES = {
    "String": "string char text guid uuid uniqueidentifier binary varbinary image json object variant".split(),
    "BigInt": "integer int int64 int32 int16 smallinteger biginteger byte tinyinteger".split(),
    "Double": "float double real".split(),
    "Decimal": "decimal numeric money smallmoney".split(),
    "Boolean": "boolean bool".split(),
    "DateTime": "date datetime datetimeoffset time timestamp".split(),
}
CDM_SEMANTIC = {
    "String": "name fullname firstname lastname middlename email phone phonenumber fax url uri webaddress ipaddress ipv4address ipv6address address city stateorprovince country postalcode county languagetag locale culturetag timezone currencycode colorname colorvalue filename filepath mimetype code tickersymbol accountcode productcode transactioncode referencecode".split(),
    "Double": "latitude longitude distance weight height area volume temperature percentage probability".split(),
    "BigInt": "year month day week quarter fiscalyear fiscalmonth fiscalquarter age duration count quantity sequence ordinal statuscode statecode versionnumber filesize".split(),
    "Decimal": "currency basecurrency exchangerate amount price tax discount".split(),
}
CDM_TRAITS = {
    "BigInt": "is.dataFormat.integer is.dataFormat.big is.dataFormat.small is.dataFormat.byte".split(),
    "Double": ["is.dataFormat.floatingPoint"],
    "Decimal": ["is.dataFormat.numeric.shaped"],
    "Boolean": ["is.dataFormat.boolean"],
    "DateTime": "is.dataFormat.date is.dataFormat.time is.dataFormat.timeOffset".split(),
    "String": "is.dataFormat.character is.dataFormat.array is.dataFormat.guid".split(),
}
#: Types of a union, the most restrictive first.
UNION_ORDER = ["Boolean", "BigInt", "Double", "DateTime", "String"]
TARGET_XSD = {"String": "string", "Boolean": "boolean", "DateTime": "dateTime", "BigInt": "integer", "Double": "double", "Decimal": "decimal", "Int": "int", "Long": "long", "Float": "float"}
#: Pre-flight checks know fewer types than the converter.
CHECKED_XSD = "string boolean dateTime date dateTimeStamp integer int long double float decimal anyURI time".split()
FAMILIES = {"integer": ("BigInt", "Int", "Long"), "float": ("Double", "Float", "Decimal"), "text": ("String",), "time": ("DateTime",), "flag": ("Boolean",)}
REGISTERED = ("String", "Boolean", "DateTime", "BigInt", "Double", "Int", "Long", "Float", "Decimal")
SEMANTIC = {
    "double": "Temperature Length Distance Velocity Speed Pressure Mass Weight Energy Power Voltage Current Resistance Capacitance Frequency Humidity Illuminance Luminance Angle Area Volume Percentage Ratio Concentration".split(),
    "duration": ["TimeSpan"],
}


def _pairs(table: dict[str, list[str]], prefix: str = "") -> dict[str, str]:
    return {prefix + s: t for t, ss in table.items() for s in ss}


def _lookup(table: dict[str, str], key: Column) -> Column:
    flat = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*flat), key)


def xsd_type(uri: Column) -> Column:
    """The target type of an XSD type; String for others and for none."""
    return F.coalesce(_lookup(_pairs(XSD_TYPES, XSD), uri), F.lit("String"))


def is_known_xsd(uri: Column) -> Column:
    return F.coalesce(uri.isin(list(_pairs(XSD_TYPES, XSD))), F.lit(False))


def dtdl_type(name: Column) -> Column:
    return F.coalesce(_lookup(_pairs(DTDL_TYPES), name), F.lit("String"))


def cdm_type(name: Column, traits: Column | None = None, *, strict: bool = False) -> Column:
    """Struct (type, how): primitive, then semantic, then the first trait that says a type, then String with a warning;
    in strict mode an unknown type is an error."""
    low = F.lower(name)
    primitive, semantic = _lookup(_pairs(CDM_PRIMITIVES), low), _lookup(_pairs(CDM_SEMANTIC), low)
    of = _pairs(CDM_TRAITS)
    trait = F.get(F.filter(F.transform(traits, lambda t: _lookup(of, t)), lambda t: t.isNotNull()), F.lit(0)) if traits is not None else F.lit(None).cast("string")
    rest = F.raise_error(F.concat(F.lit("unknown type: "), F.coalesce(name, F.lit("")))) if strict else F.lit("String")
    how = F.when(primitive.isNotNull(), "primitive").when(semantic.isNotNull(), "semantic").when(trait.isNotNull(), "trait").otherwise("default")
    return F.struct(F.coalesce(primitive, semantic, trait, rest).alias("type"), how.alias("how"))


def is_cdm_type(name: Column) -> Column:
    return F.coalesce(F.lower(name).isin([*_pairs(CDM_PRIMITIVES), *_pairs(CDM_SEMANTIC)]), F.lit(False))


def cdm_mappings(spark: SparkSession) -> DataFrame:
    """All CDM mappings, as a table (source, target, how)."""
    rows = [(s, t, "primitive") for s, t in _pairs(CDM_PRIMITIVES).items()] + [(s, t, "semantic") for s, t in _pairs(CDM_SEMANTIC).items()]
    return spark.createDataFrame(rows, "source string, target string, how string")


def union_type(types: Column) -> Column:
    """Of a union of target types the first in UNION_ORDER; String for an empty one."""
    out = F.lit("String")
    for t in reversed(UNION_ORDER):
        out = F.when(F.array_contains(types, t), t).otherwise(out)
    return out


def _one_of(names: tuple[str, ...]):
    return lambda t: t.isin(*names)


def family_type(types: Column) -> Column:
    """One type stands for itself; types of one family become its first; others String."""
    out = F.lit("String")
    for names in FAMILIES.values():
        out = F.when((F.size(types) > 0) & F.forall(types, _one_of(names)), names[0]).otherwise(out)
    return F.when(F.size(F.array_distinct(types)) == 1, F.get(types, F.lit(0))).otherwise(out)


def target_xsd(name: Column) -> Column:
    """The XSD type that a target type is exported as."""
    return F.concat(F.lit(XSD), F.coalesce(_lookup(TARGET_XSD, name), F.lit("string")))


def semantic_schema(name: Column) -> Column:
    """The schema that values of a semantic type have; null for unknown names."""
    return _lookup(_pairs(SEMANTIC), name)


class Registry:
    """Mappings of several formats: (format, source, target, loses precision), aliases, defaults, converters of values."""

    def __init__(self) -> None:
        self.rows: dict[tuple[str, str], tuple[str, bool]] = {}
        self.aliases: dict[str, str] = {}
        self.defaults: dict[str, str] = {}
        self.converters: dict[tuple[str, str], Callable[[Column], Column]] = {}

    def format(self, name: str, default: str = "String") -> None:
        self.defaults[name.lower()] = default

    def add(self, fmt: str, source: str, target: str, *, loses: bool = False, convert: Callable[[Column], Column] | None = None) -> None:
        if target not in REGISTERED:
            raise ValueError(f"not a target type: {target}")
        self.defaults.setdefault(fmt.lower(), "String")
        self.rows[fmt.lower(), source] = (target, loses)
        if convert:
            self.converters[fmt.lower(), source] = convert

    def alias(self, name: str, fmt: str) -> None:
        self.aliases[name.lower()] = fmt.lower()

    def resolve(self, fmt: str) -> str:
        return self.aliases.get(fmt.lower(), fmt.lower())

    def type_of(self, fmt: str, source: Column) -> Column:
        fmt = self.resolve(fmt)
        own = {s: t for (f, s), (t, _) in self.rows.items() if f == fmt}
        default = F.lit(self.defaults.get(fmt, "String"))
        return F.coalesce(_lookup(own, source), default) if own else default

    def convert(self, fmt: str, source: str, value: Column) -> Column:
        """The value as the registered converter makes it; as it is where there is none."""
        f = self.converters.get((self.resolve(fmt), source))
        return f(value) if f else value

    def losing(self, fmt: str) -> list[str]:
        return sorted(s for (f, s), (_, x) in self.rows.items() if f == self.resolve(fmt) and x)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(f, s, t, x) for (f, s), (t, x) in sorted(self.rows.items())]
        return spark.createDataFrame(rows, "format string, source string, target string, precision_loss boolean")


def default_registry() -> Registry:
    r = Registry()
    for fmt, table, prefix in (("rdf", XSD_TYPES, XSD), ("dtdl", DTDL_TYPES, ""), ("cdm", CDM_PRIMITIVES, "")):
        for s, t in _pairs(table, prefix).items():
            r.add(fmt, s, t, loses=fmt != "cdm" and s.endswith("decimal"))
    for name, fmt in (("ttl", "rdf"), ("owl", "rdf"), ("turtle", "rdf"), ("json-ld", "dtdl"), ("model.json", "cdm")):
        r.alias(name, fmt)
    return r
