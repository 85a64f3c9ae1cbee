"""Writers, result documents and cache scopes."""
