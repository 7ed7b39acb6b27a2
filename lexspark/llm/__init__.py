"""Operations on training text.  Nothing outside this folder imports it."""
