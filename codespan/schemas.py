"""Table layouts and code tables.

A *project* is a plain ``dict[str, DataFrame]`` keyed by the table names below.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "str": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "dbl": T.DoubleType(),
    "bool": T.BooleanType(),
    "ts": T.TimestampType(),
    "bin": T.BinaryType(),
}


def _struct(spec: str) -> T.StructType:
    """Build a schema from ``"Id Name Color:int"`` (string unless typed)."""
    fields = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        fields.append(T.StructField(name, _TYPES[kind or "str"], True))
    return T.StructType(fields)


_AUDIT = " CreatedBy CreatedDate:ts ModifiedBy ModifiedDate:ts"
AUDIT_COLUMNS = ["CreatedBy", "CreatedDate", "ModifiedBy", "ModifiedDate"]

# Table and column names of the canonical layout.
CANONICAL = {
    "User": _struct("Id Name"),
    "Project": _struct("Version Title Description" + _AUDIT),
    "NodeCategory": _struct("Id Name Description" + _AUDIT),
    "Node": _struct("Id Parent Category Name Description Color:int Aggregate:bool" + _AUDIT),
    "NodeAttribute": _struct("Id Name Description Type Length:int" + _AUDIT),
    "NodeValue": _struct("Node Attribute Value" + _AUDIT),
    "SourceCategory": _struct("Id Name Description" + _AUDIT),
    "Source": _struct(
        "Id Category Name Description Color:int Content ObjectType SourceType:int"
        " Object:bin Thumbnail:bin" + _AUDIT
    ),
    "SourceAttribute": _struct("Id Name Description Type Length:int" + _AUDIT),
    "SourceValue": _struct("Source Attribute Value" + _AUDIT),
    "Tagging": _struct("Id Source Node Fragment Memo" + _AUDIT),
}

PRIMARY_KEYS = {
    "User": ["Id"],
    "Project": [],
    "NodeCategory": ["Id"],
    "Node": ["Id"],
    "NodeAttribute": ["Id"],
    "NodeValue": ["Node", "Attribute"],
    "SourceCategory": ["Id"],
    "Source": ["Id"],
    "SourceAttribute": ["Id"],
    "SourceValue": ["Source", "Attribute"],
    "Tagging": ["Id"],
}

# (child table, child columns, parent table, parent columns)
FOREIGN_KEYS = [
    ("Node", ["Parent"], "Node", ["Id"]),
    ("Node", ["Category"], "NodeCategory", ["Id"]),
    ("NodeValue", ["Node"], "Node", ["Id"]),
    ("NodeValue", ["Attribute"], "NodeAttribute", ["Id"]),
    ("Source", ["Category"], "SourceCategory", ["Id"]),
    ("SourceValue", ["Source"], "Source", ["Id"]),
    ("SourceValue", ["Attribute"], "SourceAttribute", ["Id"]),
    ("Tagging", ["Source"], "Source", ["Id"]),
    ("Tagging", ["Node"], "Node", ["Id"]),
] + [
    (table, [column], "User", ["Id"])
    for table in CANONICAL
    if table != "User"
    for column in ("CreatedBy", "ModifiedBy")
]

# Children first, so that rows can go before the rows they refer to.
DELETE_ORDER = [
    "Tagging", "SourceValue", "SourceAttribute", "Source", "SourceCategory",
    "NodeValue", "NodeAttribute", "Node", "NodeCategory", "Project", "User",
]

FORMAT_VERSION = "0.2"

LEGACY = {
    "UserProfile": _struct("Id Name Initials"),
    "Project": _struct(
        "Version Title Description UnassignedLabel NotApplicableLabel" + _AUDIT
    ),
    "Item": _struct(
        "Id TypeId:int Name Description ColorArgb:int Aggregate:bool System:bool"
        " ReadOnly:bool InheritPermissions:bool HierarchicalName" + _AUDIT
    ),
    "Role": _struct("Item1_Id Item2_Id TypeId:int Tag:int"),
    "ExtendedItem": _struct("Item_Id Properties"),
    "Category": _struct("Item_Id Part:int Layout"),
    "Source": _struct(
        "Item_Id TypeId:int Object:bin PlainText MetaData ContentLocation"
        " Thumbnail:bin Waveform:bin LengthX:int LengthY:int"
    ),
    "NodeReference": _struct(
        "Id Node_Item_Id Source_Item_Id StartX:long LengthX:long StartY:long LengthY:long"
        " StartZ:long StartText:long LengthText:long ReferenceTypeId:int ClusterId:int" + _AUDIT
    ),
    "Annotation": _struct(
        "Id Item_Id Text StartX:long LengthX:long StartY:long LengthY:long"
        " StartText:long LengthText:long" + _AUDIT
    ),
    "BlobStorage": _struct("Content_Id Object:bin"),
}

LEGACY_KEYS = {
    "UserProfile": ["Id"],
    "Project": [],
    "Item": ["Id"],
    "Role": ["Item1_Id", "Item2_Id", "TypeId"],
    "ExtendedItem": ["Item_Id"],
    "Category": ["Item_Id", "Part"],
    "Source": ["Item_Id"],
    "NodeReference": ["Id"],
    "Annotation": ["Id"],
}

_FLAT_AUDIT = " owner date dateM status:int"

# The eighteen tables of the flat-code layout.
FLATCODE = {
    "project": _struct("databaseversion date dateM memo about imageDir"),
    "source": _struct("name id:long file memo" + _FLAT_AUDIT),
    "fileAttr": _struct("variable value fileID:long" + _FLAT_AUDIT),
    "filecat": _struct("name fid:long catid:long memo" + _FLAT_AUDIT),
    "annotation": _struct("fid:long position:long annotation" + _FLAT_AUDIT),
    "attributes": _struct("name memo class" + _FLAT_AUDIT),
    "caseAttr": _struct("variable value caseID:long" + _FLAT_AUDIT),
    "caselinkage": _struct(
        "caseid:long fid:long selfirst:dbl selend:dbl status:int owner date memo"
    ),
    "cases": _struct("name memo id:long" + _FLAT_AUDIT),
    "codecat": _struct("name cid:long catid:long memo" + _FLAT_AUDIT),
    "coding": _struct(
        "cid:long fid:long seltext selfirst:dbl selend:dbl status:int owner date memo"
    ),
    "coding2": _struct(
        "cid:long fid:long seltext selfirst:dbl selend:dbl status:int owner date memo"
    ),
    "freecode": _struct("name memo id:long color" + _FLAT_AUDIT),
    "image": _struct("name id:long" + _FLAT_AUDIT),
    "imageCoding": _struct(
        "cid:long iid:long x1:int y1:int x2:int y2:int memo" + _FLAT_AUDIT
    ),
    "journal": _struct("name journal" + _FLAT_AUDIT),
    "treecode": _struct("cid:long catid:long memo" + _FLAT_AUDIT),
    "treefile": _struct("fid:long catid:long memo" + _FLAT_AUDIT),
}

# The tables an import opens; the remaining ones belong to the image part.
FLATCODE_READ = [
    "project", "source", "fileAttr", "filecat", "annotation", "attributes", "caseAttr",
    "caselinkage", "cases", "codecat", "coding", "freecode", "journal", "treecode", "treefile",
]
FLATCODE_VERSION = "DBVersion:0.1"

IMAGECODING = {
    "attributes": _struct("id:long name memo"),
    "codes": _struct("id:long name memo color"),
    "imageAttributes": _struct("images_id:long attributes_id:long value"),
    "imageCoding": _struct(
        "images_id:long codes_id:long x1:int y1:int x2:int y2:int owner date:ts memo"
    ),
    "images": _struct("id:long name owner date:ts status:int memo"),
}

# Codes of the legacy graph.
ITEM_TYPE = {
    "folder": 0,
    "node": 16,
    "attribute_name": 20,
    "attribute_value": 21,
    "source_classification": 51,
    "node_classification": 52,
    "case": 62,
}
ROLE_TYPE = {
    "member": 0,
    "parent": 1,
    "node_index": 2,
    "attribute_value": 6,
    "item_value": 7,
    "attribute_classification": 13,
    "item_category": 14,
    "node_aggregate": 15,
}
DATA_TYPES = {
    0: "text", 1: "integer", 2: "decimal", 3: "datetime", 4: "date", 5: "time", 6: "boolean",
}
OBJECT_TYPES = {0: "DOC", 1: "MP3", 5: "WMV", 8: "JPEG", 11: "PDF"}
SHIFT = 0x377
PROPERTIES_NAMESPACE = "http://qsr.com.au/XMLSchema.xsd"

SYSTEM_FOLDERS = {
    "node_category": "Node Classifications",
    "case_category": "Case Classifications",
    "source_category": "Source Classifications",
    "node": "Nodes",
    "case": "Cases",
    "source": "Internals",
}

DEFAULT_USER = "Default User"
DEFAULT_DESCRIPTION = "Created by codespan"
