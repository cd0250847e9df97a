"""Operations for preparing training text at scale; their queries are in ``queries``."""
