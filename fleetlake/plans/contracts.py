"""Entity contracts (C2): name -> Spark DDL.

Fixed values: these column lists, types and NOT NULL markers must equal the
upstream service contracts so conformed tables line up with what users of the
export API already hold. Columns keep their upstream camelCase names. NOT NULL
is a validation rule (file sources always read nullable), checked by
``operators.quality.nullability_report``.
"""

from __future__ import annotations

# --- fixed values: contract DDLs, one per entity, in upstream column order ---
CONTRACT_DDL: dict[str, str] = {
    "action_availability_status": """
        `action` STRING NOT NULL,
        `isAvailable` BOOLEAN NOT NULL,
        `notSupportedReason` STRING
    """,
    "alert": """
        `id` STRING NOT NULL,
        `incidentId` BIGINT,
        `investigationId` BIGINT,
        `assignedTo` STRING,
        `severity` STRING NOT NULL,
        `status` STRING NOT NULL,
        `classification` STRING,
        `determination` STRING,
        `investigationState` STRING,
        `detectionSource` STRING,
        `detectorId` STRING,
        `category` STRING,
        `threatFamilyName` STRING,
        `title` STRING,
        `description` STRING,
        `alertCreationTime` TIMESTAMP,
        `firstEventTime` TIMESTAMP,
        `lastEventTime` TIMESTAMP,
        `lastUpdateTime` TIMESTAMP,
        `resolvedTime` TIMESTAMP,
        `machineId` STRING,
        `computerDnsName` STRING,
        `rbacGroupName` STRING,
        `aadTenantId` STRING,
        `relatedUser` STRUCT<`userName`: STRING, `domainName`: STRING>,
        `threatName` STRING,
        `mitreTechniques` ARRAY<STRING>,
        `loggedOnUsers` ARRAY<STRUCT<`accountName`: STRING, `domainName`: STRING>>,
        `comments` ARRAY<STRUCT<`comment`: STRING, `createdBy`: STRING, `createdTime`: TIMESTAMP NOT NULL>>,
        `evidence` ARRAY<STRUCT<`entityType`: STRING NOT NULL, `evidenceCreationTime`: TIMESTAMP NOT NULL, `sha1`: STRING, `sha256`: STRING, `fileName`: STRING, `filePath`: STRING, `processId`: BIGINT, `processCommandLine`: STRING, `processCreationTime`: TIMESTAMP, `parentProcessId`: BIGINT, `parentProcessCreationTime`: TIMESTAMP, `parentProcessFileName`: STRING, `parentProcessFilePath`: STRING, `ipAddress`: STRING, `url`: STRING, `registryKey`: STRING, `registryHive`: STRING, `registryValueType`: STRING, `registryValue`: STRING, `registryValueName`: STRING, `accountName`: STRING, `domainName`: STRING, `userSid`: STRING, `aadUserId`: STRING, `userPrincipalName`: STRING, `detectionStatus`: STRING>>,
        `domains` ARRAY<STRUCT<`host`: STRING NOT NULL>>
    """,
    "asset_baseline_assessment": """
        `id` STRING,
        `configurationId` STRING,
        `deviceId` STRING,
        `deviceName` STRING,
        `profileId` STRING,
        `osPlatform` STRING,
        `osVersion` STRING,
        `rbacGroupId` BIGINT NOT NULL,
        `rbacGroupName` STRING,
        `isApplicable` BOOLEAN NOT NULL,
        `isCompliant` BOOLEAN,
        `dataCollectionTimeOffset` STRING,
        `complianceCalculationTimeOffset` STRING,
        `recommendedValue` ARRAY<STRING>,
        `currentValue` ARRAY<STRING>,
        `rawValue` ARRAY<STRING>,
        `source` ARRAY<STRING>,
        `isExempt` BOOLEAN NOT NULL,
        `complianceEvaluationDetails` STRING
    """,
    "asset_browser_extension": """
        `deviceId` STRING,
        `rbacGroupId` BIGINT NOT NULL,
        `rbacGroupName` STRING,
        `installationTime` TIMESTAMP,
        `browserName` STRING,
        `extensionId` STRING,
        `extensionName` STRING,
        `extensionDescription` STRING,
        `extensionVersion` STRING,
        `extensionRisk` STRING,
        `extensionVendor` STRING,
        `isActivated` BOOLEAN NOT NULL
    """,
    "asset_certificate_assessment": """
        `deviceId` STRING,
        `deviceName` STRING,
        `thumbprint` STRING,
        `path` STRING,
        `signatureAlgorithm` STRING,
        `keySize` INT NOT NULL,
        `expirationDate` TIMESTAMP NOT NULL,
        `issueDate` TIMESTAMP NOT NULL,
        `subjectType` STRING,
        `serialNumber` STRING,
        `issuedTo` STRING,
        `issuedBy` STRING,
        `keyUsage` STRING,
        `extendedKeyUsage` STRING,
        `rbacGroupId` INT NOT NULL,
        `rbacGroupName` STRING
    """,
    "asset_configuration": """
        `deviceId` STRING,
        `rbacGroupId` BIGINT NOT NULL,
        `rbacGroupName` STRING,
        `deviceName` STRING,
        `osPlatform` STRING,
        `osVersion` STRING,
        `timestamp` STRING,
        `configurationId` STRING,
        `configurationCategory` STRING,
        `configurationSubcategory` STRING,
        `configurationImpact` DOUBLE NOT NULL,
        `isCompliant` BOOLEAN NOT NULL,
        `isApplicable` BOOLEAN NOT NULL,
        `isExpectedUserImpact` BOOLEAN NOT NULL,
        `configurationName` STRING,
        `recommendationReference` STRING
    """,
    "asset_hardware_firmware": """
        `deviceId` STRING,
        `rbacGroupId` BIGINT NOT NULL,
        `rbacGroupName` STRING,
        `deviceName` STRING,
        `componentType` STRING,
        `manufacturer` STRING,
        `componentName` STRING,
        `componentVersion` STRING,
        `additionalFields` STRING
    """,
    "asset_non_cpe_software": """
        `deviceId` STRING,
        `rbacGroupId` BIGINT NOT NULL,
        `rbacGroupName` STRING,
        `deviceName` STRING,
        `osPlatform` STRING,
        `softwareVendor` STRING,
        `softwareName` STRING,
        `softwareVersion` STRING,
        `softwareLastSeenTimestamp` STRING,
        `registryPath` STRING
    """,
    "asset_software": """
        `deviceId` STRING,
        `rbacGroupId` BIGINT NOT NULL,
        `rbacGroupName` STRING,
        `deviceName` STRING,
        `osPlatform` STRING,
        `softwareVendor` STRING,
        `softwareName` STRING,
        `softwareVersion` STRING,
        `numberOfWeaknesses` INT NOT NULL,
        `diskPaths` ARRAY<STRING>,
        `registryPaths` ARRAY<STRING>,
        `softwareFirstSeenTimestamp` STRING,
        `endOfSupportStatus` STRING,
        `endOfSupportDate` STRING
    """,
    "asset_vulnerability": """
        `id` STRING,
        `deviceId` STRING,
        `rbacGroupId` BIGINT NOT NULL,
        `rbacGroupName` STRING,
        `deviceName` STRING,
        `osPlatform` STRING,
        `osVersion` STRING,
        `osArchitecture` STRING,
        `softwareVendor` STRING,
        `softwareName` STRING,
        `softwareVersion` STRING,
        `cveId` STRING,
        `vulnerabilitySeverityLevel` STRING,
        `recommendedSecurityUpdate` STRING,
        `recommendedSecurityUpdateId` STRING,
        `recommendedSecurityUpdateUrl` STRING,
        `diskPaths` ARRAY<STRING>,
        `registryPaths` ARRAY<STRING>,
        `lastSeenTimestamp` STRING,
        `firstSeenTimestamp` STRING,
        `endOfSupportStatus` STRING,
        `endOfSupportDate` STRING,
        `exploitabilityLevel` STRING,
        `recommendationReference` STRING,
        `cvssScore` DOUBLE NOT NULL,
        `securityUpdateAvailable` BOOLEAN NOT NULL,
        `cveMitigationStatus` STRING
    """,
    "auth_scan_history_contract": """
        `orgId` STRING,
        `scanDefinitionId` STRING,
        `sessionId` STRING,
        `scannerId` STRING,
        `numberOfSuccessfullyScannedTargets` INT NOT NULL,
        `numberOfTargets` INT NOT NULL,
        `scanStatus` STRING,
        `generalErrorMessage` STRING,
        `scannedTargets` ARRAY<STRUCT<`scanDuration`: STRING NOT NULL, `ip`: STRING, `hostname`: STRING, `scannedDeviceDescription`: STRING, `errorMessage`: STRING, `scanStatus`: STRING>>
    """,
    "baseline_configuration": """
        `id` STRING NOT NULL,
        `uniqueId` STRING,
        `benchmarkName` STRING,
        `benchmarkVersion` STRING,
        `name` STRING,
        `description` STRING,
        `category` STRING,
        `complianceLevels` ARRAY<STRING>,
        `cce` STRING,
        `rationale` STRING,
        `remediation` STRING,
        `recommendedValue` ARRAY<STRING>,
        `source` ARRAY<STRING>,
        `isCustom` BOOLEAN,
        `assessmentMethod` STRING
    """,
    "baseline_exception": """
        `id` STRING NOT NULL,
        `approvedBy` STRING,
        `justification` STRING,
        `dueDate` TIMESTAMP NOT NULL,
        `description` STRING,
        `status` STRING,
        `isActive` BOOLEAN NOT NULL,
        `softwareName` STRING,
        `softwareVersion` STRING,
        `benchmarkName` STRING,
        `benchmarkVersion` STRING,
        `complianceLevel` STRING,
        `configurations` ARRAY<STRUCT<`id`: STRING, `title`: STRING>>,
        `devices` ARRAY<STRUCT<`id`: STRING, `name`: STRING, `rbacGroupId`: INT NOT NULL>>,
        `lastModifiedOn` TIMESTAMP,
        `lastModifiedBy` STRUCT<`id`: STRING, `email`: STRING>,
        `title` STRING,
        `createdOn` TIMESTAMP,
        `requester` STRUCT<`id`: STRING, `email`: STRING>
    """,
    "baseline_profile": """
        `id` STRING NOT NULL,
        `name` STRING,
        `description` STRING,
        `benchmark` STRING,
        `version` STRING,
        `operatingSystem` STRING,
        `operatingSystemVersion` STRING,
        `status` BOOLEAN NOT NULL,
        `complianceLevel` STRING,
        `settingsNumber` INT NOT NULL,
        `createdBy` STRING,
        `lastUpdatedBy` STRING,
        `createdOnTimeOffset` TIMESTAMP NOT NULL,
        `lastUpdateTimeOffset` TIMESTAMP NOT NULL,
        `passedDevices` INT NOT NULL,
        `totalDevices` INT NOT NULL,
        `rbacGroupIdsProfileScope` ARRAY<INT> NOT NULL,
        `rbacGroupNamesProfileScope` ARRAY<STRING>,
        `deviceTagsProfileScope` ARRAY<STRING>
    """,
    "browser_extension_permission": """
        `id` STRING NOT NULL,
        `isRequired` BOOLEAN NOT NULL,
        `risk` STRING
    """,
    "browser_extensions": """
        `key` STRING NOT NULL,
        `permissionName` STRING,
        `description` STRING
    """,
    "configuration_score": """
        `time` TIMESTAMP NOT NULL,
        `score` DOUBLE NOT NULL,
        `rbacGroupName` STRING,
        `rbacGroupId` BIGINT
    """,
    "data_export_settings": """
        `id` STRING NOT NULL,
        `designatedTenantId` STRING,
        `eventHubProperties` STRUCT<`eventHubResourceId`: STRING, `subscriptionId`: STRING, `resourceGroup`: STRING, `namespace`: STRING, `name`: STRING>,
        `storageAccountProperties` STRUCT<`storageAccountResourceId`: STRING, `subscriptionId`: STRING, `resourceGroup`: STRING, `name`: STRING>,
        `workspaceProperties` STRUCT<`workspaceResourceId`: STRING, `subscriptionId`: STRING, `resourceGroup`: STRING, `name`: STRING>,
        `logs` ARRAY<STRUCT<`category`: STRING, `enabled`: BOOLEAN NOT NULL>>
    """,
    "delta_asset_vulnerability": """
        `id` STRING,
        `deviceId` STRING,
        `rbacGroupId` BIGINT NOT NULL,
        `rbacGroupName` STRING,
        `deviceName` STRING,
        `osPlatform` STRING,
        `osVersion` STRING,
        `osArchitecture` STRING,
        `softwareVendor` STRING,
        `softwareName` STRING,
        `softwareVersion` STRING,
        `cveId` STRING,
        `vulnerabilitySeverityLevel` STRING,
        `recommendedSecurityUpdate` STRING,
        `recommendedSecurityUpdateId` STRING,
        `recommendedSecurityUpdateUrl` STRING,
        `diskPaths` ARRAY<STRING>,
        `registryPaths` ARRAY<STRING>,
        `lastSeenTimestamp` STRING,
        `firstSeenTimestamp` STRING,
        `endOfSupportStatus` STRING,
        `endOfSupportDate` STRING,
        `exploitabilityLevel` STRING,
        `recommendationReference` STRING,
        `cvssScore` DOUBLE NOT NULL,
        `securityUpdateAvailable` BOOLEAN NOT NULL,
        `cveMitigationStatus` STRING,
        `status` STRING,
        `eventTimestamp` TIMESTAMP NOT NULL
    """,
    "device_authenticated_scan_agent": """
        `id` STRING NOT NULL,
        `machineId` STRING,
        `lastSeen` TIMESTAMP NOT NULL,
        `computerDnsName` STRING,
        `assignedApplicationId` STRING,
        `scannerSoftwareVersion` STRING,
        `lastCommandExecutionTimestamp` TIMESTAMP NOT NULL,
        `mdeClientVersion` STRING
    """,
    "device_authenticated_scan_definition": """
        `id` STRING NOT NULL,
        `scanType` STRING NOT NULL,
        `scanName` STRING,
        `isActive` BOOLEAN NOT NULL,
        `scanAuthenticationParams` STRUCT<`keyVaultUri`: STRING, `keyVaultSecretName`: STRING, `type`: STRING, `username`: STRING, `password`: STRING, `domain`: STRING, `isgmsaUser`: BOOLEAN, `packetPrivacy`: BOOLEAN, `packetIntegrity`: BOOLEAN, `privateKey`: STRING, `communityString`: STRING, `authProtocol`: STRING, `authPassword`: STRING, `privProtocol`: STRING, `privPassword`: STRING>,
        `target` STRING,
        `scannerAgent` STRUCT<`id`: STRING, `machineId`: STRING, `machineName`: STRING, `lastSeen`: TIMESTAMP NOT NULL, `assignedApplicationId`: STRING, `scannerSoftwareVersion`: STRING, `lastCommandExecutionTimestamp`: TIMESTAMP NOT NULL, `mdeClientVersion`: STRING>,
        `orgId` STRING,
        `latestScan` STRUCT<`status`: STRING, `failureReason`: STRING, `executionDateTime`: TIMESTAMP>,
        `intervalInHours` INT,
        `createdBy` STRING,
        `targetType` STRING,
        `isTroubleshootMode` BOOLEAN NOT NULL,
        `advancedActiveConfiguration` STRUCT<`addresses`: ARRAY<STRING>, `siteId`: STRING, `scanIdentifier`: STRING, `maxConcurrentScans`: INT NOT NULL, `portCheckTimeout`: FLOAT NOT NULL, `singleScanTimeout`: INT NOT NULL, `disabledScanners`: ARRAY<STRING>, `enabledEndpoints`: ARRAY<STRING>, `exportHMI`: BOOLEAN NOT NULL, `externalAddress`: BOOLEAN NOT NULL, `enableTCPPortScan`: BOOLEAN NOT NULL, `exportSuccessfullOnlyAddresses`: BOOLEAN NOT NULL, `zone`: STRING, `force`: BOOLEAN NOT NULL, `safe`: BOOLEAN NOT NULL>
    """,
    "device_av_info": """
        `id` STRING NOT NULL,
        `machineId` STRING,
        `computerDnsName` STRING,
        `osKind` STRING,
        `osPlatform` STRING,
        `osVersion` STRING,
        `avMode` STRING,
        `avSignatureVersion` STRING,
        `avEngineVersion` STRING,
        `avPlatformVersion` STRING,
        `lastSeenTime` TIMESTAMP NOT NULL,
        `quickScanResult` STRING,
        `quickScanError` STRING,
        `quickScanTime` TIMESTAMP,
        `fullScanResult` STRING,
        `fullScanError` STRING,
        `fullScanTime` TIMESTAMP,
        `dataRefreshTimestamp` TIMESTAMP NOT NULL,
        `avEngineUpdateTime` TIMESTAMP,
        `avSignatureUpdateTime` TIMESTAMP,
        `avPlatformUpdateTime` TIMESTAMP,
        `avIsSignatureUpToDate` STRING,
        `avIsEngineUpToDate` STRING,
        `avIsPlatformUpToDate` STRING,
        `avSignaturePublishTime` TIMESTAMP,
        `avSignatureDataRefreshTime` TIMESTAMP,
        `cloudProtectionState` STRING,
        `avModeDataRefreshTime` TIMESTAMP,
        `rbacGroupName` STRING,
        `rbacGroupId` BIGINT
    """,
    "device_group": """
        `id` INT NOT NULL,
        `priority` INT NOT NULL,
        `deviceGroupName` STRING,
        `isUnassignedDeviceGroup` BOOLEAN NOT NULL,
        `automationLevel` STRING NOT NULL,
        `description` STRING,
        `deviceCount` INT NOT NULL,
        `lastUpdateTime` TIMESTAMP,
        `aadUsersGroups` ARRAY<STRUCT<`displayName`: STRING, `id`: STRING>>,
        `deviceGroupRules` STRUCT<`devicesNamesConditions`: ARRAY<STRUCT<`condition`: STRING NOT NULL, `value`: STRING>>, `devicesDomainsConditions`: ARRAY<STRUCT<`condition`: STRING NOT NULL, `value`: STRING>>, `devicesTagsConditions`: ARRAY<STRUCT<`condition`: STRING NOT NULL, `value`: STRING>>, `devicesOsConditions`: ARRAY<STRUCT<`condition`: STRING NOT NULL, `valuesList`: ARRAY<STRING>>>>
    """,
    "dlp_machine": """
        `id` STRING,
        `computerDnsName` STRING,
        `healthStatus` STRING NOT NULL,
        `configStatus` STRING NOT NULL,
        `lastSeen` TIMESTAMP,
        `osPlatform` STRING,
        `version` STRING
    """,
    "domain": """
        `host` STRING NOT NULL
    """,
    "export_files_response": """
        `exportFiles` ARRAY<STRING>,
        `generatedTime` TIMESTAMP
    """,
    "file": """
        `sha1` STRING NOT NULL,
        `sha256` STRING,
        `md5` STRING,
        `globalPrevalence` BIGINT,
        `globalFirstObserved` TIMESTAMP,
        `globalLastObserved` TIMESTAMP,
        `size` BIGINT,
        `fileType` STRING,
        `isPeFile` BOOLEAN,
        `filePublisher` STRING,
        `fileProductName` STRING,
        `signer` STRING,
        `issuer` STRING,
        `signerHash` STRING,
        `isValidCertificate` BOOLEAN,
        `determinationType` STRING NOT NULL,
        `determinationValue` STRING
    """,
    "firmware": """
        `name` STRING NOT NULL,
        `type` STRING,
        `vendor` STRING,
        `family` STRING,
        `version` STRING,
        `additionalFields` STRING
    """,
    "in_org_domain_stats": """
        `host` STRING,
        `orgPrevalence` STRING,
        `orgFirstSeen` TIMESTAMP,
        `orgLastSeen` TIMESTAMP,
        `organizationPrevalence` INT
    """,
    "in_org_file_stats": """
        `sha1` STRING,
        `orgPrevalence` STRING,
        `organizationPrevalence` INT,
        `orgFirstSeen` TIMESTAMP,
        `orgLastSeen` TIMESTAMP,
        `globalPrevalence` STRING,
        `globallyPrevalence` INT,
        `globalFirstObserved` TIMESTAMP,
        `globalLastObserved` TIMESTAMP,
        `topFileNames` ARRAY<STRING>
    """,
    "in_org_ip_stats": """
        `ipAddress` STRING,
        `orgPrevalence` STRING,
        `organizationPrevalence` INT,
        `orgFirstSeen` TIMESTAMP,
        `orgLastSeen` TIMESTAMP
    """,
    "incident": """
        `incidentId` BIGINT NOT NULL,
        `incidentUri` STRING,
        `redirectIncidentId` BIGINT,
        `incidentName` STRING,
        `createdTime` TIMESTAMP NOT NULL,
        `lastUpdateTime` TIMESTAMP NOT NULL,
        `assignedTo` STRING,
        `classification` STRING NOT NULL,
        `determination` STRING NOT NULL,
        `status` STRING NOT NULL,
        `severity` STRING NOT NULL,
        `tags` ARRAY<STRING>,
        `comments` ARRAY<STRUCT<`comment`: STRING, `createdBy`: STRING, `createdTime`: TIMESTAMP NOT NULL>>,
        `alerts` ARRAY<STRUCT<`alertId`: STRING, `providerAlertId`: STRING, `incidentId`: BIGINT NOT NULL, `serviceSource`: STRING NOT NULL, `creationTime`: TIMESTAMP, `lastUpdatedTime`: TIMESTAMP, `resolvedTime`: TIMESTAMP, `firstActivity`: TIMESTAMP, `lastActivity`: TIMESTAMP, `title`: STRING, `description`: STRING, `category`: STRING, `status`: STRING NOT NULL, `severity`: STRING NOT NULL, `investigationId`: BIGINT, `investigationState`: STRING, `classification`: STRING, `determination`: STRING, `detectionSource`: STRING, `detectorId`: STRING, `assignedTo`: STRING, `actorName`: STRING, `threatFamilyName`: STRING, `mitreTechniques`: ARRAY<STRING>, `devices`: ARRAY<STRUCT<`mdatpDeviceId`: STRING, `aadDeviceId`: STRING, `deviceDnsName`: STRING, `osPlatform`: STRING, `version`: STRING, `osProcessor`: STRING, `osBuild`: BIGINT, `healthStatus`: STRING, `riskScore`: STRING, `rbacGroupName`: STRING, `firstSeen`: TIMESTAMP, `tags`: ARRAY<STRING>, `vmMetadata`: STRUCT<`vmId`: STRING, `cloudProvider`: STRING NOT NULL, `resourceId`: STRING, `subscriptionId`: STRING>, `onboardingStatus`: STRING, `loggedOnUsers`: ARRAY<STRUCT<`accountName`: STRING, `domainName`: STRING>>>>, `entities`: ARRAY<STRUCT<`entityType`: STRING NOT NULL, `evidenceCreationTime`: TIMESTAMP NOT NULL, `verdict`: STRING NOT NULL, `remediationStatus`: STRING NOT NULL, `remediationStatusDetails`: STRING, `sha1`: STRING, `sha256`: STRING, `fileName`: STRING, `filePath`: STRING, `processId`: BIGINT, `processCommandLine`: STRING, `processCreationTime`: TIMESTAMP, `parentProcessId`: BIGINT, `parentProcessCreationTime`: TIMESTAMP, `parentProcessFileName`: STRING, `parentProcessFilePath`: STRING, `ipAddress`: STRING, `url`: STRING, `accountName`: STRING, `domainName`: STRING, `userSid`: STRING, `aadUserId`: STRING, `userPrincipalName`: STRING, `mailboxDisplayName`: STRING, `mailboxAddress`: STRING, `clusterBy`: STRING, `clusterByValue`: STRING, `emailCount`: BIGINT, `sender`: STRING, `recipient`: STRING, `subject`: STRING, `internetMessageId`: STRING, `deliveryAction`: STRING, `securityGroupId`: STRING, `securityGroupName`: STRING, `registryHive`: STRING, `registryKey`: STRING, `registryValueType`: STRING, `registryValue`: STRING, `detectionStatus`: STRING, `deviceId`: STRING, `applicationId`: STRING, `applicationObjectId`: STRING, `applicationName`: STRING, `risk`: STRING, `publisher`: STRING>>>>
    """,
    "indicator": """
        `id` STRING NOT NULL,
        `indicatorValue` STRING,
        `indicatorType` STRING NOT NULL,
        `action` STRING NOT NULL,
        `createdBy` STRING,
        `severity` STRING NOT NULL,
        `category` INT,
        `application` STRING,
        `educateUrl` STRING,
        `bypassDurationHours` INT,
        `title` STRING,
        `description` STRING,
        `recommendedActions` STRING,
        `creationTimeDateTimeUtc` TIMESTAMP NOT NULL,
        `expirationTime` TIMESTAMP,
        `lastUpdateTime` TIMESTAMP NOT NULL,
        `lastUpdatedBy` STRING,
        `rbacGroupNames` ARRAY<STRING>,
        `rbacGroupIds` ARRAY<INT> NOT NULL,
        `certificateInfo` STRUCT<`issuer`: STRING, `serial`: STRING, `subject`: STRING, `sha256`: STRING>,
        `notificationId` SMALLINT,
        `notificationBody` STRING,
        `version` STRING,
        `mitreTechniques` ARRAY<STRING>,
        `historicalDetection` BOOLEAN NOT NULL,
        `lookBackPeriod` INT,
        `generateAlert` BOOLEAN NOT NULL,
        `additionalInfo` STRING,
        `createdByDisplayName` STRING,
        `externalId` STRING,
        `createdBySource` STRING NOT NULL
    """,
    "investigation": """
        `id` STRING NOT NULL,
        `startTime` TIMESTAMP,
        `endTime` TIMESTAMP,
        `state` STRING NOT NULL,
        `cancelledBy` STRING,
        `statusDetails` STRING,
        `machineId` STRING,
        `computerDnsName` STRING,
        `triggeringAlertId` STRING
    """,
    "ip": """
        `id` STRING NOT NULL
    """,
    "library_files": """
        `fileName` STRING NOT NULL,
        `sha256` STRING,
        `description` STRING,
        `creationTime` TIMESTAMP NOT NULL,
        `lastUpdatedTime` TIMESTAMP NOT NULL,
        `createdBy` STRING,
        `hasParameters` BOOLEAN NOT NULL,
        `parametersDescription` STRING
    """,
    "list_1_of_import_indicator_result": """
        `capacity` INT NOT NULL
    """,
    "list_1_of_indicator": """
        `capacity` INT NOT NULL
    """,
    "machine": """
        `id` STRING NOT NULL,
        `mergedIntoMachineId` STRING,
        `isPotentialDuplication` BOOLEAN NOT NULL,
        `isExcluded` BOOLEAN NOT NULL,
        `exclusionReason` STRING,
        `computerDnsName` STRING,
        `firstSeen` TIMESTAMP,
        `lastSeen` TIMESTAMP,
        `osPlatform` STRING,
        `osProcessor` STRING,
        `version` STRING,
        `lastIpAddress` STRING,
        `lastExternalIpAddress` STRING,
        `agentVersion` STRING,
        `osBuild` BIGINT,
        `healthStatus` STRING NOT NULL,
        `deviceValue` STRING NOT NULL,
        `rbacGroupId` INT NOT NULL,
        `rbacGroupName` STRING,
        `ipAddresses` ARRAY<STRUCT<`ipAddress`: STRING, `macAddress`: STRING, `type`: STRING, `operationalStatus`: STRING>>,
        `riskScore` STRING,
        `exposureLevel` STRING NOT NULL,
        `isAadJoined` BOOLEAN,
        `aadDeviceId` STRING,
        `machineTags` ARRAY<STRING>,
        `vmMetadata` STRUCT<`vmId`: STRING, `cloudProvider`: STRING NOT NULL, `resourceId`: STRING, `subscriptionId`: STRING>,
        `onboardingStatus` STRING NOT NULL,
        `osArchitecture` STRING,
        `managedBy` STRING NOT NULL,
        `managedByStatus` STRING NOT NULL
    """,
    "machine_action": """
        `id` STRING NOT NULL,
        `type` STRING NOT NULL,
        `title` STRING,
        `requestor` STRING,
        `requestorComment` STRING,
        `status` STRING NOT NULL,
        `machineId` STRING,
        `computerDnsName` STRING,
        `relatedFileInfo` STRUCT<`fileIdentifier`: STRING, `fileIdentifierType`: STRING>,
        `creationDateTimeUtc` TIMESTAMP NOT NULL,
        `lastUpdateDateTimeUtc` TIMESTAMP NOT NULL,
        `cancellationRequestor` STRING,
        `cancellationComment` STRING,
        `cancellationDateTimeUtc` TIMESTAMP,
        `errorHResult` INT NOT NULL,
        `scope` STRING,
        `commands` ARRAY<STRUCT<`index`: INT NOT NULL, `command`: STRUCT<`type`: STRING NOT NULL, `params`: ARRAY<STRUCT<`key`: STRING NOT NULL, `value`: STRING>>>, `startTime`: TIMESTAMP, `endTime`: TIMESTAMP, `commandStatus`: STRING NOT NULL, `errors`: ARRAY<STRING>>>,
        `troubleshootInfo` STRUCT<`expirationUtc`: TIMESTAMP NOT NULL, `startTsModeUtc`: TIMESTAMP NOT NULL, `paramsJsonFormatVersion`: INT NOT NULL, `state`: INT NOT NULL>,
        `externalId` STRING,
        `requestSource` STRING NOT NULL
    """,
    "public_asset_dto": """
        `id` STRING,
        `computerDnsName` STRING,
        `osPlatform` STRING,
        `assetCriticalityLevel` STRING,
        `tags` ARRAY<STRING>,
        `rbacGroupName` STRING,
        `rbacGroupId` BIGINT
    """,
    "public_asset_vulnerability_dto": """
        `id` STRING,
        `cveId` STRING,
        `machineId` STRING,
        `fixingKbId` STRING,
        `productName` STRING,
        `productVendor` STRING,
        `productVersion` STRING,
        `severity` STRING
    """,
    "public_distribution_dto": """
        `version` STRING,
        `installations` BIGINT NOT NULL,
        `vulnerabilities` BIGINT NOT NULL
    """,
    "public_product_dto": """
        `id` STRING NOT NULL,
        `name` STRING,
        `vendor` STRING,
        `weaknesses` BIGINT NOT NULL,
        `publicExploit` BOOLEAN NOT NULL,
        `activeAlert` BOOLEAN NOT NULL,
        `exposedMachines` BIGINT NOT NULL,
        `installedMachines` BIGINT NOT NULL,
        `impactScore` FLOAT NOT NULL,
        `isNormalized` BOOLEAN NOT NULL,
        `category` STRING
    """,
    "public_product_fix_dto": """
        `id` STRING,
        `name` STRING,
        `osBuild` BIGINT,
        `productsNames` ARRAY<STRING>,
        `url` STRING,
        `machineMissedOn` BIGINT NOT NULL,
        `cveAddressed` BIGINT NOT NULL
    """,
    "public_vulnerability_dto": """
        `id` STRING NOT NULL,
        `name` STRING,
        `description` STRING,
        `severity` STRING,
        `cvssV3` DOUBLE NOT NULL,
        `cvssVector` STRING,
        `exposedMachines` BIGINT NOT NULL,
        `publishedOn` TIMESTAMP NOT NULL,
        `updatedOn` TIMESTAMP NOT NULL,
        `firstDetected` TIMESTAMP,
        `patchFirstAvailable` TIMESTAMP,
        `publicExploit` BOOLEAN NOT NULL,
        `exploitVerified` BOOLEAN NOT NULL,
        `exploitInKit` BOOLEAN NOT NULL,
        `exploitTypes` ARRAY<STRING>,
        `exploitUris` ARRAY<STRING>,
        `cveSupportability` STRING,
        `tags` ARRAY<STRING>,
        `epss` DOUBLE NOT NULL,
        `status` STRING NOT NULL
    """,
    "recommendation": """
        `id` STRING NOT NULL,
        `productName` STRING,
        `recommendationName` STRING,
        `weaknesses` BIGINT NOT NULL,
        `vendor` STRING,
        `recommendedVersion` STRING,
        `recommendedVendor` STRING,
        `recommendedProgram` STRING,
        `recommendationCategory` STRING,
        `subCategory` STRING,
        `severityScore` DOUBLE NOT NULL,
        `publicExploit` BOOLEAN NOT NULL,
        `activeAlert` BOOLEAN NOT NULL,
        `associatedThreats` ARRAY<STRING>,
        `remediationType` STRING,
        `status` STRING NOT NULL,
        `configScoreImpact` DOUBLE NOT NULL,
        `exposureImpact` DOUBLE NOT NULL,
        `totalMachineCount` BIGINT NOT NULL,
        `exposedMachinesCount` BIGINT NOT NULL,
        `nonProductivityImpactedAssets` BIGINT NOT NULL,
        `relatedComponent` STRING,
        `hasUnpatchableCve` BOOLEAN NOT NULL,
        `tags` ARRAY<STRING>,
        `exposedCriticalDevices` BIGINT NOT NULL
    """,
    "remediation_task": """
        `id` STRING NOT NULL,
        `title` STRING,
        `createdOn` TIMESTAMP,
        `requesterId` STRING,
        `requesterEmail` STRING,
        `status` STRING,
        `statusLastModifiedOn` TIMESTAMP NOT NULL,
        `description` STRING,
        `relatedComponent` STRING,
        `targetDevices` INT,
        `rbacGroupNames` ARRAY<STRING>,
        `fixedDevices` INT,
        `requesterNotes` STRING,
        `dueOn` TIMESTAMP,
        `category` STRING,
        `productivityImpactRemediationType` STRING,
        `priority` STRING,
        `completionMethod` STRING,
        `completerId` STRING,
        `completerEmail` STRING,
        `scid` STRING,
        `type` STRING,
        `productId` STRING,
        `vendorId` STRING,
        `nameId` STRING,
        `recommendedVersion` STRING,
        `recommendedVendor` STRING,
        `recommendedProgram` STRING,
        `recommendationReference` STRING
    """,
    "software": """
        `id` STRING NOT NULL,
        `name` STRING,
        `vendor` STRING,
        `weaknesses` BIGINT NOT NULL,
        `publicExploit` BOOLEAN NOT NULL,
        `activeAlert` BOOLEAN NOT NULL,
        `exposedMachines` BIGINT NOT NULL,
        `installedMachines` BIGINT NOT NULL,
        `impactScore` FLOAT NOT NULL,
        `isNormalized` BOOLEAN NOT NULL,
        `category` STRING,
        `distributions` ARRAY<STRUCT<`version`: STRING, `installations`: BIGINT NOT NULL, `vulnerabilities`: BIGINT NOT NULL>>
    """,
    "user": """
        `id` STRING NOT NULL,
        `accountName` STRING,
        `accountDomain` STRING,
        `accountSid` STRING,
        `firstSeen` TIMESTAMP,
        `lastSeen` TIMESTAMP,
        `mostPrevalentMachineId` STRING,
        `leastPrevalentMachineId` STRING,
        `logonTypes` STRING,
        `logOnMachinesCount` BIGINT,
        `isDomainAdmin` BOOLEAN,
        `isOnlyNetworkUser` BOOLEAN
    """,
    "vulnerability": """
        `id` STRING NOT NULL,
        `name` STRING,
        `description` STRING,
        `severity` STRING,
        `cvssV3` DOUBLE NOT NULL,
        `cvssVector` STRING,
        `exposedMachines` BIGINT NOT NULL,
        `publishedOn` TIMESTAMP NOT NULL,
        `updatedOn` TIMESTAMP NOT NULL,
        `firstDetected` TIMESTAMP,
        `patchFirstAvailable` TIMESTAMP,
        `publicExploit` BOOLEAN NOT NULL,
        `exploitVerified` BOOLEAN NOT NULL,
        `exploitInKit` BOOLEAN NOT NULL,
        `exploitTypes` ARRAY<STRING>,
        `exploitUris` ARRAY<STRING>,
        `cveSupportability` STRING,
        `tags` ARRAY<STRING>,
        `epss` DOUBLE NOT NULL,
        `status` STRING NOT NULL
    """,
    "import_indicator_result": """
        `id` STRING, `indicator` STRING, `isFailed` BOOLEAN NOT NULL, `failureReason` STRING
    """,
}


import re
from functools import lru_cache

from pyspark.sql.types import ArrayType, StructType

_NOT_NULL = re.compile(r"`([^`]+)`\s*:?\s*[^,`]*?NOT NULL")


class UnknownContractError(KeyError):
    """Raised when a contract name is not in :data:`CONTRACT_DDL`."""


def contract_names() -> list[str]:
    return list(CONTRACT_DDL)


def _ddl(name: str) -> str:
    try:
        return CONTRACT_DDL[name]
    except KeyError:
        raise UnknownContractError(f"unknown contract {name!r}") from None


@lru_cache(maxsize=None)
def contract(name: str) -> StructType:
    """Contract ``name`` as a nullable ``StructType``.

    Spark's file sources read every column nullable, so ``NOT NULL`` is
    stripped here and kept as a validation rule (:func:`required_columns`).
    """
    ddl = _ddl(name).replace("NOT NULL", "")
    return StructType.fromDDL(" ".join(ddl.split()))


@lru_cache(maxsize=None)
def declared(name: str) -> StructType:
    """Contract ``name`` with its declared nullability on every level."""
    return StructType.fromDDL(" ".join(_ddl(name).split()))


def required_columns(name: str) -> list[str]:
    """Top-level columns declared NOT NULL in the contract."""
    return [f.name for f in declared(name).fields if not f.nullable]


def required_nested(name: str) -> dict[str, list[str]]:
    """Per top-level array/struct column: the NOT NULL fields directly inside it."""
    out: dict[str, list[str]] = {}
    for f in declared(name).fields:
        inner = f.dataType.elementType if isinstance(f.dataType, ArrayType) else f.dataType
        if isinstance(inner, StructType) and (fields := [x.name for x in inner.fields if not x.nullable]):
            out[f.name] = fields
    return out


