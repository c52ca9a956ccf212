"""The reference's models as DataFrame plans (one function per model/CTE)."""
