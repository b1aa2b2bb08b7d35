"""Schemas of elements and changes."""

from __future__ import annotations

MEMBER = "struct<type:tinyint,ref:bigint,role:string>"
TAGS = "map<string,string>"
NODES = f"id bigint, lon double, lat double, tags {TAGS}"
WAYS = f"id bigint, refs array<bigint>, tags {TAGS}"
RELATIONS = f"id bigint, members array<{MEMBER}>, tags {TAGS}"
CHANGES = f"seq bigint, ord bigint, action string, kind string, id bigint, lon double, lat double, refs array<bigint>, members array<{MEMBER}>, tags {TAGS}"
#: Codes of member types.
MEMBER_TYPES = {"node": 0, "way": 1, "relation": 2}
