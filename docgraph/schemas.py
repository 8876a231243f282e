"""Schemas of the engine's tables."""

PARAMETER = "struct<name:string,type:string>"
MEMBER = f"struct<name:string,kind:string,declaring_type:string,raw_signature:string,return_type:string,parameters:array<{PARAMETER}>,summary:string,remarks:string,examples:array<string>,see_also:array<string>,source_url:string>"
ENUM_MEMBER = "struct<enum_name:string,member_name:string,numeric_value:string,description:string,source_url:string>"
LINK = "struct<name:string,url:string,member_kind:string,declaring_type_hint:string>"
PAGE = (
    "version string, namespace string, type_name string, full_type_name string, kind string, declaring_type string, base_type string,"
    f" inheritance_chain array<string>, implemented_interfaces array<string>, members array<{MEMBER}>, enum_members array<{ENUM_MEMBER}>,"
    " summary string, remarks string, examples array<string>, see_also array<string>, source_url string, parser_notes array<string>"
)
PARSED = f"struct<{PAGE.replace(' ', ':').replace(',:', ',')},links:array<{LINK}>,members_page:string,sniffed:string>"
CORROBORATION = "dll_signature_verified boolean, dll_relationship_scope string, dll_semantic_verified boolean, dll_verified_status string, lookup_referenced boolean, lookup_requires_document_context boolean"
NODES = "full_type_name string, short_name string, kind string, namespace string, base_type string, inheritance_chain array<string>, is_element_candidate string, class_role string, evidence array<string>, source_url string, dll_type_verified boolean"
EDGES = "source_type string, member_name string, member_kind string, raw_signature string, return_type string, parameter_types array<string>, candidate_target_type string, candidate_edge_type string, edge_confidence string, evidence array<string>, source_url string, parser_notes array<string>, " + CORROBORATION
MANIFEST = (
    "revit_version string, generated_at string, namespace_prefix string, assemblies_scanned array<struct<path:string,name:string,matched:boolean>>,"
    " types array<struct<full_type_name:string,assembly:string,kind:string,is_abstract:boolean,base_type:string,inheritance_chain:array<string>,implemented_interfaces:array<string>,"
    "members:array<struct<name:string,kind:string,declaring_type:string,return_type:string,is_static:boolean,parameters:array<struct<name:string,type:string>>>>,enum_members:array<string>>>"
)
RESOLVED = "struct<member_name:string,name_source:string,requires_document_context:boolean,has_multiple_variants:boolean>"
DESCRIPTOR = f"struct<descriptor_class:string,resolved_members:array<{RESOLVED}>,synthetic_extensions:array<string>,parser_notes:array<string>>"
MAP_ENTRY = "struct<target_type_short_name:string,descriptor_class:string,section:string>"
REFERENCE = f"revitlookup_tag string, descriptor_map array<{MAP_ENTRY}>, descriptors array<{DESCRIPTOR}>"
ENTRY = "url string, link_text string, discovered_via string, declaring_type_hint string"
