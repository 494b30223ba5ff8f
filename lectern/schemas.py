"""Explicit schemas: inference mistypes the arrays that are always empty."""

SEGMENT = "struct<role:string,n:int,father:string,text:string>"
CITATION = "struct<raw:string,kind:string,target_id:string>"
SOURCE = (
    "struct<edition:string,translator:string,license:string,url:string,"
    "retrieved:string,via:string,electronic_edition:string>"
)

NODE = (
    "id string, work string, citation string, title string, path array<string>, type string, "
    f"text string, segments array<{SEGMENT}>, citations_out array<{CITATION}>, source {SOURCE}"
)
VERSE = NODE + ", lang string, book string, douay_book string, latin_book string, chapter int, verse int, verse_key string"
PERICOPE = NODE + ", lemma string, commented_verse_keys array<string>"

ADJACENCY_ENTRY = "struct<id:string,citation:string,title:string,ref:string>"
READING = "date date, gospel string, day string"
