"""PNG files to arrays of pixels, many files of one shape at a time."""

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}  # per pixel, by colour type: grey, RGB, palette, grey and alpha, RGBA


class Unreadable(ValueError):
    """Bytes that are no whole PNG file."""


def parsed(content: bytes) -> dict:
    """The parts of a file that its pixels depend on."""
    if content[:8] != SIGNATURE:
        raise Unreadable("no PNG signature")
    at, found, body = 8, {}, []
    while at + 12 <= len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        data = content[at + 8 : at + 8 + size]
        if kind == b"IHDR" and size == 13:
            width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", data)
            if interlaced:
                raise ValueError("interlaced PNG files are not supported")
            found |= {"width": width, "height": height, "depth": depth, "colour": colour}
        elif kind in (b"PLTE", b"tRNS"):
            found[kind.decode()] = data
        elif kind == b"IDAT":
            body.append(data)
        elif kind == b"IEND":
            break
        at += 12 + size
    try:
        lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
        stride = -(-found["width"] * SAMPLES[found["colour"]] * found["depth"] // 8)
        found["lines"] = lines.reshape(found["height"], 1 + stride)
    except (zlib.error, KeyError, ValueError) as error:
        raise Unreadable(str(error)) from error
    return found


def unfiltered(lines: np.ndarray, step: int) -> np.ndarray:
    """Bytes of files x lines x (filter, bytes) without the filters; ``step`` is the distance of the byte to the left."""
    files, height, width = lines.shape
    width -= 1
    out = np.zeros((files, height + 1, step + width), np.uint8)  # a line of zeros above, a pixel of zeros to the left
    for y in range(height):
        kind, raw = lines[:, y, 0], lines[:, y, 1:]
        above, now = out[:, y], out[:, y + 1]
        now[:, step:] = raw
        up = kind == 2
        now[up, step:] += above[up, step:]
        left = np.flatnonzero(kind == 1)
        if len(left):
            columns = -(-width // step)
            padded = np.zeros((len(left), columns * step), np.uint8)
            padded[:, :width] = raw[left]
            sums = np.cumsum(padded.reshape(len(left), columns, step), axis=1, dtype=np.uint8)
            now[left, step:] = sums.reshape(len(left), -1)[:, :width]
        for wanted in (3, 4):  # these look at the byte just made, so pixels go one by one, files all at once
            rows = np.flatnonzero(kind == wanted)
            if not len(rows):
                continue
            made, over = now[rows].astype(np.int16), above[rows].astype(np.int16)
            for x in range(step, step + width, step):
                to = min(x + step, step + width)
                a, b, c = made[:, x - step : to - step], over[:, x:to], over[:, x - step : to - step]
                if wanted == 3:
                    guess = (a + b) >> 1
                else:
                    pa, pb, pc = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
                    guess = np.where((pa <= pb) & (pa <= pc), a, np.where(pb <= pc, b, c))
                made[:, x:to] = (made[:, x:to] + guess) & 255
            now[rows] = made.astype(np.uint8)
        if (kind > 4).any():
            raise Unreadable("unknown filter")
    return out[:, 1:, step:]


def pixels(files: list[dict]) -> np.ndarray:
    """files x height x width x channels of files of one shape and kind: grey, BGR, or BGRA, 8 bits each."""
    head = files[0]
    depth, colour, width = head["depth"], head["colour"], head["width"]
    count = SAMPLES[colour]
    raw = unfiltered(np.stack([f["lines"] for f in files]), max(1, count * depth // 8))
    if depth < 8:
        bits = np.unpackbits(raw, axis=2).reshape(*raw.shape[:2], -1, depth)
        values = bits @ (1 << np.arange(depth)[::-1])
        values = values[:, :, : width * count]
        values = values if colour == 3 else values * (255 // ((1 << depth) - 1))
    elif depth == 16:
        wide = raw.reshape(*raw.shape[:2], -1, 2).astype(np.uint32)
        values = ((wide[..., 0] * 256 + wide[..., 1]) * 255 + 32767) // 65535
    else:
        values = raw
    tiles = values.astype(np.uint8).reshape(len(files), head["height"], width, count)
    if colour == 3:
        found = []
        for tile, file in zip(tiles, files):
            table = np.zeros((256, 4), np.uint8)
            table[:, 3] = 255
            known = np.frombuffer(file["PLTE"], np.uint8).reshape(-1, 3)
            table[: len(known), :3] = known
            clear = np.frombuffer(file.get("tRNS", b""), np.uint8)
            table[: len(clear), 3] = clear
            found.append(table[tile[..., 0]][..., : 4 if len(clear) else 3])
        tiles = np.stack(found)
    elif colour == 4:
        tiles = tiles[..., [0, 0, 0, 1]]
    return tiles if tiles.shape[-1] == 1 else tiles[..., [2, 1, 0, 3][: tiles.shape[-1]]]


def decoded(contents: list[bytes]) -> list[np.ndarray | None]:
    """The pixels of each file; None for bytes that are no PNG file."""
    found: list = [None] * len(contents)
    kinds: dict[tuple, list] = {}
    for number, content in enumerate(contents):
        try:
            file = parsed(content)
        except Unreadable:
            continue
        key = (*(file[k] for k in ("height", "width", "depth", "colour")), bool(file.get("tRNS")))
        kinds.setdefault(key, []).append((number, file))
    for members in kinds.values():
        try:
            tiles = pixels([file for _, file in members])
        except Unreadable:  # one of them; find out which
            tiles = [_alone(file) for _, file in members]
        for (number, _), tile in zip(members, tiles):
            found[number] = tile
    return found


def _alone(file: dict) -> np.ndarray | None:
    try:
        return pixels([file])[0]
    except Unreadable:
        return None
