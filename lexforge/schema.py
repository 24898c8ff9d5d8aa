"""Schemas of the nested and tabular data."""

from __future__ import annotations

WORD = "struct<id:int,deprel:string,deps:string,feats:string,head:int,lemma:string,misc:string,text:string,upos:string,xpos:string>"
TOKEN = f"struct<start_char:int,end_char:int,id:array<int>,misc:string,ner:string,text:string,whitespace:boolean,words:array<{WORD}>,identifier:string,urn:string>"
SIDECAR = f"urn string, lang string, tokens array<{TOKEN}>"
CORPUS = "name string, tag_name string, repo_owner string, repo_name string, branch string"
MANIFEST = "version_path string, chunk_name string, sha string, lang string, pipeline string"
METADATA = "struct<document:struct<base_urn:string,title:string,author:string,source_repo:string>>"
CHUNK_INDEX = "struct<chunks:array<struct<file:string>>>"

#: Tokens in one context window, and what parts them.
CONTEXT_PART, TOKEN_SEP = 32, "\x1f"
DEFAULT_LANGS = ("grc", "la")
SCHEMA_VERSION = 4
SIDECAR_SCHEMA = 2
SIDECAR_SUFFIX = ".tokens.json.zst"
SEGMENT_CHARS, LANGID_SAMPLE_CHARS = 2000, 3000
