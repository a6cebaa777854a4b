"""Write TFRecord files for the tests."""

import struct


def _crc(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    crc ^= 0xFFFFFFFF
    return struct.pack("<I", ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF)


def _varint(n):
    n &= (1 << 64) - 1
    out = b""
    while True:
        n, low = n >> 7, n & 0x7F
        out += bytes([low | (0x80 if n else 0)])
        if not n:
            return out


def _message(number, data):
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def example(features):
    """`features` maps a name to a non-empty or typed-empty list: (kind, values)."""
    entries = b""
    for name, (kind, values) in features.items():
        if kind == "bytes":
            inner = _message(1, b"".join(_message(1, v) for v in values))
        elif kind == "float":
            inner = _message(2, _message(1, struct.pack(f"<{len(values)}f", *values)) if values else b"")
        else:
            inner = _message(3, _message(1, b"".join(map(_varint, values))) if values else b"")
        entries += _message(1, _message(1, name.encode()) + _message(2, inner))
    return _message(1, entries)


def write(path, examples):
    with open(path, "wb") as out:
        for features in examples:
            payload = example(features)
            size = struct.pack("<Q", len(payload))
            out.write(size + _crc(size) + payload + _crc(payload))


def three_records(path):
    write(path, [
        {"id": ("int", [i]), "name": ("bytes", [f"record_{i}".encode()]), "score": ("float", [i * 1.5])} for i in range(3)
    ])
