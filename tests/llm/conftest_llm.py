"""Text makers that the tests of this folder share."""


def prose(seed: int, n: int) -> str:
    """``n`` words that no other seed has."""
    return " ".join(f"w{seed}x{i}" for i in range(n))


def thue_morse(order):
    """Two different words of 2 ** order bytes that every polynomial modulo 2^64 with an odd base confuses."""
    a, b = "a", "b"
    for _ in range(order):
        a, b = a + b, b + a
    return a, b
