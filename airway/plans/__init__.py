"""airway.plans"""
