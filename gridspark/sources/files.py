"""Opening files from inside a task, on any file system the cluster shares."""

from __future__ import annotations

import re


def filesystem(uri: str):
    """(pyarrow file system, path) of a Spark path."""
    import pyarrow.fs as pafs

    uri = re.sub(r"^s3[an]://", "s3://", uri)
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def open_file(uri: str):
    """Seekable binary reader."""
    from urllib.parse import unquote

    fs, path = filesystem(uri)
    return fs.open_input_file(unquote(path))


def _glob(pattern: str) -> re.Pattern:
    """Wildcards of a path: ``*`` and ``?`` inside a folder's name, ``[ab]`` and ``{a,b}``."""
    out, braces = "", 0
    for ch in pattern:
        if ch == "{":
            braces += 1
        elif ch == "}" and braces:
            braces -= 1
            out += ")"
            continue
        out += {"*": "[^/]*", "?": "[^/]", "{": "(?:", ",": "|" if braces else ",", "[": "[", "]": "]"}.get(ch) or re.escape(ch)
    return re.compile(out + "(/.*)?")


def list_files(uri: str) -> list[tuple[str, int]]:
    """(uri, bytes) of the files at or below a path, which may hold wildcards; names that start with ``_`` or ``.`` are hidden."""
    from urllib.parse import quote

    import pyarrow.fs as pafs

    steps = uri.rstrip("/").split("/")
    wild = next((i for i, s in enumerate(steps) if re.search(r"[*?\[{]", s)), len(steps))
    fs, base = filesystem("/".join(steps[:wild]))
    base = base.rstrip("/")
    info = fs.get_file_info(base)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(base, recursive=True))
    wanted = _glob("/".join(steps[wild:])) if wild < len(steps) else None
    scheme = re.match(r"([A-Za-z][\w+.-]*)://([^/]*)", uri)
    out = []
    for f in found:
        inside = f.path[len(base) :].lstrip("/")
        hidden = any(s[:1] in ("_", ".") for s in inside.split("/") if s)
        if f.type != pafs.FileType.File or hidden or (wanted and not wanted.fullmatch(inside)):
            continue
        if isinstance(fs, pafs.LocalFileSystem):
            at = "file:" + quote(f.path)
        else:
            at = f"{scheme[1]}://{scheme[2] if f.path.startswith('/') else ''}{quote(f.path)}"
        out.append((at, f.size))
    return sorted(out)
