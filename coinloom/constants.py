"""Fixed values of the ledger."""

# Address ids: the emission contract, the treasury, the fee contract, and the two re-emission contracts
EMISSION, TREASURY, FEES, REEMISSION, PAY_TO_REEMISSION = 13, 33, 2403, 5965233, 5993503
EMISSION_CONTRACTS = (EMISSION, REEMISSION, PAY_TO_REEMISSION)
P2PK, MINER, OTHER = 1, 2, 3
MINER_PREFIX = "88dhgzEuTX"
VOTING_EPOCH_LENGTH, ROLLBACK_HORIZON = 1024, 20
GENESIS_TIMESTAMP, GENESIS_PRICE = 1561978800000, 5.581469768257971
HOUR_MS, DAY_MS, WEEK_MS = 3_600_000, 86_400_000, 604_800_000
#: Balance bands in nano units, from any balance to a million coins
BANDS = {"total": 1, "ge_0p001": 10**6, "ge_0p01": 10**7, "ge_0p1": 10**8, "ge_1": 10**9, "ge_10": 10**10, "ge_100": 10**11, "ge_1k": 10**12, "ge_10k": 10**13, "ge_100k": 10**14, "ge_1m": 10**15}
DEFAULT_RC_PRICE = 1_000_000
PARAMETERS = {0: "parameter_0", 1: "storage_fee_factor", 2: "min_value_per_byte", 3: "max_block_size", 4: "max_block_cost", 5: "token_access_cost", 6: "tx_input_cost", 7: "tx_data_input_cost", 8: "tx_output_cost", 123: "block_version"}
