"""Small ordinance files for the tests."""

from __future__ import annotations

import datetime
from pathlib import Path

from lawtree import schema as S
from lawtree.sources import files as sources

EPOCH = datetime.datetime(1970, 1, 1)


def law(body: str, name: str | None = "試験条例", num: str | None = "平成元年条例第一号") -> str:
    num_tag = f"<LawNum>{num}</LawNum>" if num is not None else ""
    title = f"<LawTitle>{name}</LawTitle>" if name is not None else ""
    return (
        f'<?xml version="1.0" encoding="UTF-8"?>\n<Laws><Law>{num_tag}'
        f"<LawBody>{title}{body}</LawBody></Law></Laws>"
    )


def main(inner: str) -> str:
    return f"<MainProvision>{inner}</MainProvision>"


def sentence(tag: str, *texts: str) -> str:
    return f"<{tag}>" + "".join(f"<Sentence>{t}</Sentence>" for t in texts) + f"</{tag}>"


def paragraph(num: str, *texts: str, more: str = "") -> str:
    return f'<Paragraph Num="{num}">{sentence("ParagraphSentence", *texts)}{more}</Paragraph>'


def article(num: str, inner: str = "") -> str:
    return f'<Article Num="{num}">{inner}</Article>'


SIMPLE = law(main(article("1", paragraph("1", "本文"))))


def file_rows(spark, contents: dict[str, str | bytes]):
    """FILES rows from ``{path: content}``."""
    rows = []
    for path, content in contents.items():
        data = content.encode() if isinstance(content, str) else content
        rows.append((path, EPOCH, len(data), bytearray(data)))
    raw = spark.createDataFrame(
        rows, "path string, modification_time timestamp, length long, content binary"
    )
    return sources.with_codes(raw).select(*S.FILES.fieldNames())


def one_file(spark, content: str | bytes):
    return file_rows(spark, {"/corpus/01/010001/0001.xml": content})


def write_tree(root: Path, contents: dict[str, str | bytes]) -> str:
    for path, content in contents.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content.encode() if isinstance(content, str) else content)
    return str(root)
