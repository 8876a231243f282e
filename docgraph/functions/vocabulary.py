"""Fixed values of the documentation domain: vocabularies, rule tables, selectors, field names."""

# Namespaces.
ROOT_NAMESPACE = "Autodesk.Revit"
DB_NAMESPACE = "Autodesk.Revit.DB"
OTHER_NAMESPACE_TARGETS = {"Room": "Autodesk.Revit.DB.Architecture.Room", "Schema": "Autodesk.Revit.DB.ExtensibleStorage.Schema"}

# Types that are references, scalars, or values that never are a relationship.
KNOWN_REFERENCES = ["Element", "ElementType", "Family", "FamilySymbol", "Material", "Category", "Parameter", "Definition", "View", "ViewSheet", "Level", "Phase", "Workset", "DesignOption", "FilterElement", "ParameterFilterElement", "FillPatternElement", "LinePatternElement", "Document"]
SCALARS = ["void", "bool", "int", "long", "double", "float", "string", "String", "Boolean", "Int32", "Int64", "Double", "object", "Object", "byte", "short"]
VALUE_TYPES = ["XYZ", "UV", "Color", "Plane", "Transform", "BoundingBoxXYZ", "CurveLoop", "Outline", "ForgeTypeId", "FailureDefinitionId", "ExternalServiceId", "ExternalResourceType", "IFCAnyHandle", "IFCData", "ModelPath", "FormatOptions", "FailureMessage", "FailureResolutionType", "LinkLoadResult", "Curve", "Solid", "GeometryElement", "GeometryObject", "Face", "CurveArrArray", "CurveArray", "Polyloop"]
ID_TYPES = ["ElementId", "LinkElementId"]
COLLECTIONS = ["ICollection", "IList", "ISet", "IEnumerable", "List", "HashSet"]
TYPED_IDS = {"WorksetId": ("Workset", "OWNED_BY_WORKSET")}

# Member-name rules in order of precedence: test, words, edge type, target.
KEYWORDS = [
    ("contains", ["Template"], "CONTROLLED_BY_TEMPLATE", "View"),
    ("contains", ["FillPattern"], "USES_FILL_PATTERN", "FillPatternElement"),
    ("contains", ["LinePattern"], "USES_LINE_PATTERN", "LinePatternElement"),
    ("contains", ["Material"], "USES_MATERIAL", "Material"),
    ("contains", ["Sheet"], "PLACED_ON_SHEET", "ViewSheet"),
    ("contains", ["Tag"], "TAGS_ELEMENT", None),
    ("contains", ["Host"], "HOSTED_BY", None),
    ("contains", ["Workset"], "OWNED_BY_WORKSET", "Workset"),
    ("contains", ["Level"], "ASSIGNED_TO_LEVEL", "Level"),
    ("contains", ["Phase"], "ASSIGNED_TO_PHASE", "Phase"),
    ("contains", ["DesignOption"], "ASSIGNED_TO_DESIGN_OPTION", "DesignOption"),
    ("prefix", ["GetMember"], "MEMBER_OF_GROUP", None),
    ("contains", ["Group"], "MEMBER_OF_GROUP", None),
    ("contains", ["Assembly"], "MEMBER_OF_ASSEMBLY", None),
    ("contains", ["Dependent"], "DEPENDS_ON", None),
    ("exact", ["Symbol"], "INSTANCE_OF", "FamilySymbol"),
    ("exact", ["Family"], "BELONGS_TO_FAMILY", "Family"),
    ("exact", ["Document", "GetDocument"], "REFERENCES", "Document"),
    ("exact", ["ViewId", "GetViewId"], "REFERENCES", "View"),
    ("exact", ["View"], "REFERENCES", "View"),
    ("exact", ["Location"], "REFERENCES", "Location"),
    ("exact", ["GetExternalResourceReference"], "REFERENCES", "ExternalResourceReference"),
    ("contains", ["Room"], "REFERENCES", "Room"),
    ("exact", ["Schema", "SubSchema"], "REFERENCES", "Schema"),
    ("exact", ["SketchPlane"], "REFERENCES", "SketchPlane"),
    ("suffix", ["Sketch", "SketchId"], "DEPENDS_ON", "Sketch"),
    ("exact", ["Type", "TypeId", "GetTypeId"], "TYPE_OF", None),
    ("suffix", ["ConnectorManager"], "REFERENCES", "ConnectorManager"),
    ("exact", ["ThermalProperties"], "REFERENCES", "ThermalProperties"),
    ("suffix", ["RoundingManager"], "REFERENCES", None),
    ("exact", ["Subcategory"], "REFERENCES", "GraphicsStyle"),
    ("contains", ["GraphicsStyle"], "REFERENCES", "GraphicsStyle"),
    ("contains", ["Category"], "HAS_CATEGORY", "Category"),
    ("contains", ["Parameter"], "HAS_PARAMETER", None),
    ("prefix", ["GetAll"], "RETURNS_ELEMENT_IDS", None),
    ("prefix", ["GetMaterial"], "USES_MATERIAL", "Material"),
    ("prefix", ["GetGenerating"], "DEPENDS_ON", None),
]
# Phrases of the documentation text, in order.
DOC_PHRASES = ["is controlled by", "is hosted by", "hosted by", "template for", "belongs to the family", "assigned to the level", "assigned to the phase", "owned by the workset", "member of the group", "member of the assembly", "depends on", "references the"]

# Confidence labels and tiers.
CONFIDENCE_ORDER = ["direct_return_type", "elementid_with_strong_name", "elementid_collection_with_strong_name", "docs_semantic_hint", "name_only_candidate", "unknown_reference", "needs_runtime_validation"]
CORE_CONFIDENCE = CONFIDENCE_ORDER[:4]
UNKNOWN_EDGES = ["UNKNOWN_DB_OBJECT_REFERENCE", "UNKNOWN_ELEMENTID_REFERENCE"]
EDGES_BY_MEMBER_NAME = ["UNKNOWN_ELEMENTID_REFERENCE"]

# Roles of types, in order of precedence; tests on the short name unless said otherwise.
ROLES = ["Document", "Element", "ElementType", "View", "ViewSheet", "Family", "FamilySymbol", "Parameter", "Category", "Material", "Level", "Phase", "Workset", "Group / Assembly", "Room / Space", "Annotation / Tag", "Geometry", "Failures", "Options / Settings", "Utility / Collector", "Other"]
ROLE_RULES = [
    ("Document", [("suffix", ["Document"])]),
    ("ViewSheet", [("exact", ["ViewSheet"])]),
    ("View", [("prefix", ["View"]), ("base_prefix", ["View"])]),
    ("FamilySymbol", [("contains", ["FamilySymbol"]), ("suffix_and_base_contains", ["Type", "Family"])]),
    ("Family", [("contains", ["Family"])]),
    ("Parameter", [("contains", ["Parameter"]), ("exact", ["Definition", "ExternalDefinition", "InternalDefinition"])]),
    ("Category", [("contains", ["Category"]), ("exact", ["Categories"])]),
    ("Material", [("contains", ["Material"])]),
    ("Level", [("contains", ["Level"])]),
    ("Phase", [("contains", ["Phase"])]),
    ("Workset", [("contains", ["Workset"])]),
    ("Group / Assembly", [("contains", ["Assembly", "Group"])]),
    ("Room / Space", [("contains", ["Room", "Space"]), ("suffix", ["Area"])]),
    ("Annotation / Tag", [("contains", ["Tag", "Annotation"]), ("exact", ["TextNote", "Dimension"])]),
    ("Geometry", [("exact", ["XYZ", "UV", "Curve", "Line", "Arc", "Solid", "Face", "Edge", "Mesh", "Plane", "Transform", "BoundingBoxXYZ"]), ("contains", ["Geometry"])]),
    ("Failures", [("contains", ["Failure"])]),
    ("Element", [("class_role", ["element_subtype"])]),
    ("ElementType", [("class_role", ["element_type"])]),
    ("Options / Settings", [("class_role", ["options_class"])]),
    ("Utility / Collector", [("class_role", ["utility_class"])]),
]
# Relation families.
FAMILIES = {
    "HAS_PARAMETER": "Data / Definition", "HAS_CATEGORY": "Data / Definition",
    "USES_MATERIAL": "Physical / Material", "USES_FILL_PATTERN": "Physical / Material", "USES_LINE_PATTERN": "Physical / Material",
    "ASSIGNED_TO_LEVEL": "Spatial / Level", "ASSIGNED_TO_PHASE": "Lifecycle / Phase", "ASSIGNED_TO_DESIGN_OPTION": "Design Options",
    "HOSTED_BY": "Model Structure", "DEPENDS_ON": "Model Structure", "TYPE_OF": "Model Structure", "INSTANCE_OF": "Model Structure", "BELONGS_TO_FAMILY": "Model Structure",
    "PLACED_ON_SHEET": "Documentation", "TAGS_ELEMENT": "Annotation", "REFERENCES": "Referencing",
    "OWNED_BY_WORKSET": "Collaboration", "MEMBER_OF_GROUP": "Grouping", "MEMBER_OF_ASSEMBLY": "Grouping", "CONTROLLED_BY_TEMPLATE": "View Control",
    "RETURNS_ELEMENT_IDS": "Referencing",
}

# Title suffixes in order and the kind of page that they name.
TITLE_KINDS = [("Class", "class"), ("Structure", "struct"), ("Struct", "struct"), ("Enumeration", "enum"), ("Enum", "enum"), ("Interface", "interface"), ("Property", "property"), ("Method", "method"), ("Constructor", "constructor"), ("Members", "members_index"), ("Methods", "members_index"), ("Properties", "members_index")]
# Selectors, the first that matches counts.
SELECTORS = {
    "summary": ["div.summary", "#mainSection > p:first-of-type", "div#mainBody > p:first-of-type"],
    "remarks": ["div.remarks", "#remarksSection", "div#remarks"],
    "syntax": ["div.codeSnippetContainerCode.cs pre", "div.syntax pre", "pre.typeSignature", "div#syntaxSection pre", "pre.code"],
    "examples": ["div.codeExamples pre", "div#examplesSection pre", "div.example pre"],
    "see_also": ["div.seeAlsoStyle", "div#seeAlsoSection", "div.seealso"],
    "members": ["table.members", "table#memberList", "table.memberTable"],
    "enum": ["table.enumeration", "table#enumMembers", "table.members"],
    "namespace": ["div#TopicPathClassic a", "div.topicPath a", "nav.breadcrumb a"],
}
TOC_FILES = ["toc.js", "webtoc.xml", "toc.json", "toc.html"]

# Keyword spellings of runtime types.
RUNTIME_NAMES = {"bool": "Boolean", "byte": "Byte", "sbyte": "SByte", "char": "Char", "decimal": "Decimal", "double": "Double", "float": "Single", "int": "Int32", "uint": "UInt32", "long": "Int64", "ulong": "UInt64", "short": "Int16", "ushort": "UInt16", "object": "Object", "string": "String"}

# Marks of descriptor sources.
CONTEXT_MARKS = ["RevitApi.Document", "RevitApi.ActiveView", ".Document", "FilteredWorksetCollector", "Schema.ListSchemas", "Context.ActiveView", "Context.ActiveDocument", "Context.ActiveUiDocument"]
VARIANT_MARKS = [".AppendVariant(", "Variants.Values<", "new Variants<"]
EXCLUDED_SEGMENT = "Playground"
MAP_FILES = ["DescriptorMap.cs", "DescriptorsMap.cs"]

# Names of fields in the JSON files, where ours differ.
FIELDS = {"version": "revit_version", "lookup_referenced": "revitlookup_referenced", "lookup_requires_document_context": "revitlookup_requires_document_context", "lookup_tag": "revitlookup_tag"}
