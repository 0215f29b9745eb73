"""TEI documents to titles, sections, paragraphs and references."""

from __future__ import annotations

import re
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

SPACE = "{http://www.tei-c.org/ns/1.0}"
COORDS = "array<struct<page:int,x:double,y:double,width:double,height:double>>"
TEI = (
    f"document_id string, title string, authors array<string>, sections array<struct<path:array<string>,coords:{COORDS}>>, paragraphs array<struct<text:string,section_path:array<string>,coords:{COORDS}>>, "
    f"references array<struct<reference_id:string,text:string,title:string,doi:string,coords:{COORDS}>>, error string"
)
COLUMNS = ["document_id", "title", "authors", "sections", "paragraphs", "references", "error"]


def _text(node: ElementTree.Element | None) -> str:
    return "" if node is None else " ".join("".join(node.itertext()).split())


def _coords(node: ElementTree.Element) -> list[dict]:
    number = r"\s*([-+0-9.eE]+)\s*"
    found = re.finditer(rf"(?:^|;)\s*(\d+)\s*,{number},{number},{number},{number}(?=;|$)", node.get("coords", ""))
    return [{"page": int(m[1]), "x": float(m[2]), "y": float(m[3]), "width": float(m[4]), "height": float(m[5])} for m in found]


def read_tei(xml: str) -> dict:
    """The parts of one document; other roots and documents with declarations are refused."""
    if re.search(r"<!(DOCTYPE|ENTITY)", xml):
        raise ValueError("declarations are refused")
    root = ElementTree.fromstring(xml)
    if root.tag != f"{SPACE}TEI":
        raise ValueError("the root is not TEI")
    out: dict = {"title": _text(root.find(f"{SPACE}teiHeader//{SPACE}titleStmt/{SPACE}title")), "sections": [], "paragraphs": [], "references": []}
    names = root.iterfind(f"{SPACE}teiHeader//{SPACE}sourceDesc//{SPACE}author/{SPACE}persName")
    out["authors"] = [" ".join(filter(None, map(_text, n))) for n in names]
    body = root.find(f"{SPACE}text/{SPACE}body")
    todo = [(body, [])] if body is not None else []
    while todo:  # depth first, children in order
        node, path = todo.pop()
        if node.tag == f"{SPACE}p":
            out["paragraphs"].append({"text": _text(node), "section_path": path, "coords": _coords(node)})
            continue
        head = node.find(f"{SPACE}head") if node.tag == f"{SPACE}div" else None
        if head is not None:
            path = [*path, _text(head)]
            out["sections"].append({"path": path, "coords": _coords(head)})
        todo += [(child, path) for child in reversed(node)]
    for n in root.iterfind(f".//{SPACE}listBibl/{SPACE}biblStruct"):
        dois = [_text(x) for x in n.iterfind(f".//{SPACE}idno") if (x.get("type") or "").lower() == "doi"]
        out["references"].append({
            "reference_id": n.get("{http://www.w3.org/XML/1998/namespace}id"), "text": _text(n), "title": _text(n.find(f".//{SPACE}title")), "doi": dois[0] if dois else None, "coords": _coords(n),
        })
    return out


def parse_tei(documents: DataFrame) -> DataFrame:
    """Documents (document_id, xml) as their parts; ``error`` tells why a document was refused."""

    def run(batches):
        for batch in batches:
            rows = []
            for doc, xml in zip(batch["document_id"], batch["xml"], strict=True):
                try:
                    rows.append({"document_id": doc, **read_tei(xml or ""), "error": None})
                except (ValueError, ElementTree.ParseError) as error:
                    rows.append({"document_id": doc, "title": None, "authors": [], "sections": [], "paragraphs": [], "references": [], "error": str(error)})
            yield pd.DataFrame(rows, columns=COLUMNS)

    return documents.select("document_id", "xml").mapInPandas(run, TEI)
