"""Hand-encoded minimal ONNX model (protobuf wire format) for tests: one
Relu node, float input [N, d] -> output [N, d].  No onnx package needed."""


def _varint(n: int) -> bytes:
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        out.append(b | (0x80 if n else 0))
        if not n:
            return bytes(out)


def _field(num: int, payload) -> bytes:
    if isinstance(payload, int):
        return _varint(num << 3) + _varint(payload)
    if isinstance(payload, str):
        payload = payload.encode()
    return _varint((num << 3) | 2) + _varint(len(payload)) + payload


def _value_info(name: str, dim: int) -> bytes:
    dims = _field(1, _field(2, "N")) + _field(1, _field(1, dim))       # Dimension: dim_param / dim_value
    tensor = _field(1, 1) + _field(2, dims)                              # elem_type FLOAT, shape
    return _field(1, name) + _field(2, _field(1, tensor))                # name, TypeProto.tensor_type


def relu_model(dim: int) -> bytes:
    node = _field(1, "x") + _field(2, "y") + _field(3, "relu0") + _field(4, "Relu")
    graph = _field(1, node) + _field(2, "g") + _field(11, _value_info("x", dim)) + _field(12, _value_info("y", dim))
    opset = _field(1, "") + _field(2, 13)
    return _field(1, 8) + _field(2, "ocellus-test") + _field(7, graph) + _field(8, opset)
