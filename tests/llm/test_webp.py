"""Round trips of lossless WebP images through every transform and coding tool."""

import base64

import numpy as np
import pytest

from sievelog.llm.media import store_payload, read_payload
from sievelog.llm.webp import BLACK, NEIGHBOURS, Bits, Writer, decode, distance_of, encode


def picture(seed, height=13, width=21, colours=None):
    draw = np.random.default_rng(seed)
    if colours:
        return draw.integers(0, 1 << 32, colours, dtype=np.uint64).astype(np.uint32)[draw.integers(0, colours, (height, width))]
    smooth = np.add.outer(np.arange(height), np.arange(width)).astype(np.uint32)
    return (smooth * 0x01020304 + draw.integers(0, 4, (height, width)).astype(np.uint32) * 0x00010100).astype(np.uint32)


def test_neighbours():
    assert len(set(NEIGHBOURS)) == 120 and distance_of(1, 30) == 30 and distance_of(2, 30) == 1 and distance_of(121, 30) == 1


@pytest.mark.parametrize("mode", range(14))
def test_predictors(mode):
    image = picture(mode)
    assert (decode(encode(image, modes=np.full((4, 6), mode << 8 | BLACK, np.uint32)))[0] == image).all()


@pytest.mark.parametrize("options", [{}, {"cache_bits": 4}, {"subtract_green": True}, {"elements": True}, {"elements": True, "subtract_green": True, "cache_bits": 3, "modes": True}])
def test_transforms(options):
    image, draw = picture(3), np.random.default_rng(9)
    for name in ("elements", "modes"):
        if options.get(name):
            options = options | {name: draw.integers(0, 1 << 32, (4, 6), dtype=np.uint64).astype(np.uint32) & (0x0D00 if name == "modes" else 0xFFFFFFFF)}
    assert (decode(encode(image, **options))[0] == image).all()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 5, 16, 17, 200])
@pytest.mark.parametrize("cache_bits", [0, 5])
def test_palettes(colours, cache_bits):
    image = picture(colours, 40, 37, colours)
    assert (decode(encode(image, palette=True, back=True, cache_bits=cache_bits))[0] == image).all()


@pytest.mark.parametrize("data", [b"", b"a", "é€𝄞".encode() * 50, b"abcdefgh" * 4000, bytes(range(256)) * 20, b"the quick brown fox jumps over the lazy dog; " * 30 + bytes(np.random.default_rng(1).integers(97, 120, 300_000, dtype=np.uint8)), b"x" * 1_200_000 + b"y"])
def test_payloads(data):
    payload, blob = store_payload(data)
    assert len(payload) % 64 == 0 and payload and payload.startswith(data) and read_payload(blob) == payload
    assert len(blob) < len(payload) + 400


#: Files that another encoder has made: single pixels (the usual browser probes), and the losslessly coded alpha plane of
#: the 16 x 16 picture among the test data of Python's own e-mail package.
PROBES = {"UklGRhoAAABXRUJQVlA4TA0AAAAvAAAAEAcQERGIiP4HAA==": 0, "UklGRh4AAABXRUJQVlA4TBEAAAAvAAAAAAfQ//73v/+BiOh/AAA=": 0xFFFFFFFF}
PLANE = (
    "J6KokSTleucYX+ffKpmImP90cY3gJjDi4Yt3MsjBEVyDKzDosHgVjnhRNcEIDAJPkqBqsFUZHNa2bUYvTsZ2PLbtd/uvKa4hov9J0f2PkPe6REkkGzolkTTzFG0Ox9PlFiD0CxS+kOGDtxoynjaCfx"
    "0pfk52CPuInrOR75lzRugygtv4zEiy90UwfSD9NheMITJWLaXWayO8XeOlWRXVnIGk2W6WdYoYMQ+KqixQNPowgt+6a1BSKbUtz+lUFAoBAAA="
)
#: The plane as seen by eye: the logo on a clear ground.
SHAPE = """
....+#####+.....
....#######.....
....#######+....
.+++++++###+....
+##########+##+.
##########++###.
#########+++###.
####+++++++####+
###+++#########+
###++##########+
+##+##########+.
....###++++++++.
....#######+....
....#######+....
....+#####+.....
.......+++......
"""


def test_foreign_files():
    for text, pixel in PROBES.items():
        assert decode(base64.b64decode(text))[0].tolist() == [[pixel]]
    body = bytes([0x2F]) + (15 | 15 << 14).to_bytes(4, "little") + base64.b64decode(PLANE)
    image = decode(b"RIFF" + (12 + len(body)).to_bytes(4, "little") + b"WEBPVP8L" + len(body).to_bytes(4, "little") + body)[0] >> 8 & 255
    shown = "\n".join("".join("." if v < 64 else "+" if v < 192 else "#" for v in row) for row in image)
    assert shown == SHAPE.strip()


def test_bits():
    out = Writer()
    out.many([5, 1, 1023], [3, 1, 10])
    bits = Bits(out.bytes())
    assert [bits.read(3), bits.read(1), bits.read(10)] == [5, 1, 1023]


def test_damage_is_an_error():
    blob = encode(picture(1))
    for bad in (blob[:40], b"RIFF" + blob[5:], blob[:20] + b"\0" + blob[21:]):
        with pytest.raises(ValueError):
            decode(bad)


def test_table(spark):
    import hashlib
    import zlib

    from sievelog.llm.media import media_features

    rows = [(1, "abc", "x"), (None, None, "y"), (2**53 + 1, "", None), (4, "ñ" * 70_000, "z"), (1, "abc", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, feature string").coalesce(1)
    got = sorted(media_features(df, "doc_id", "text").collect(), key=repr)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    for r in got:
        text = {1: "abc", 4: "ñ" * 70_000}.get(r.doc_id, "").encode()
        payload = text + bytes(-len(text) % 64 or (0 if text else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert media_features(df.limit(0), "doc_id", "text").count() == 0
