from tierstream.functions.text import digits_number, first_number, fingerprint, usable_key

__all__ = ["digits_number", "first_number", "fingerprint", "usable_key"]
