"""The user-level jobs, composed from functions and operators."""
