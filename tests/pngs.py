"""Tiny PNG writer (zlib + struct) for image fixtures."""

import os
import struct
import zlib


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)


def png_bytes(width: int, height: int, rgb=(255, 0, 0)) -> bytes:
    row = b"\x00" + bytes(rgb) * width
    raw = row * height
    ihdr = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", ihdr) + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")


def png_gradient(width: int, height: int) -> bytes:
    """Pixel (x, y) = (x, y, x + y) mod 256."""
    raw = b"".join(b"\x00" + b"".join(bytes((x % 256, y % 256, (x + y) % 256)) for x in range(width))
                   for y in range(height))
    ihdr = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", ihdr) + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")


def make_tree(root: str) -> dict:
    """a/ (3 red PNGs, one upper-case .PNG), b/ (2 blue PNGs, a junk .png,
    a .txt), empty/ (no files)."""
    os.makedirs(f"{root}/a"); os.makedirs(f"{root}/b"); os.makedirs(f"{root}/empty")
    files = {
        "a/a1.png": png_bytes(4, 3, (255, 0, 0)),
        "a/a2.png": png_bytes(300, 150, (255, 0, 0)),
        "a/A3.PNG": png_bytes(5, 5, (250, 10, 0)),
        "b/b1.png": png_bytes(6, 2, (0, 0, 255)),
        "b/b2.png": png_gradient(10, 8),
        "b/junk.png": b"not an image at all",
        "b/notes.txt": b"hello",
    }
    for name, data in files.items():
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)
    return files
